"""Probabilistic automata learned from strings by merging compatible states of a prefix tree."""

from __future__ import annotations

import math
from collections import Counter

FLOOR = math.log2(1e-6)  # a symbol that a state never showed


class Automaton:
    """A prefix tree of counted strings whose statistically alike states become one.

    States are compared by Hoeffding's bound on the frequencies of ending there and of each next
    symbol, and so are all pairs of states that merging them would merge. States are tried in
    order of how many strings pass through, so the same strings give the same automaton.

    What follows where a single string passes is kept as text until another one comes: such a
    state is alike to any, as the bound exceeds every difference. Long strings take no states.
    """

    def __init__(self, strings: list[str], alpha: float = 0.05) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [{}]
        self.ends = [0]
        self.total = [0]
        self.rest: list[tuple[str, int] | None] = [None]  # in unbranched states: a string, and what follows from where
        self.slack = math.sqrt(0.5 * math.log(2 / alpha))
        for s in sorted(strings):
            self._insert(0, s, 0)
        self._open(0)
        self._merge_all()

    def _open(self, state: int) -> None:
        """Give an unbranched state its end or its one next state."""
        if self.rest[state] is None:
            return
        (s, at), self.rest[state] = self.rest[state], None
        if at == len(s):
            self.ends[state] = 1
        else:
            self.seen[state][s[at]] = 1
            self.next[state][s[at]] = self._leaf(s, at + 1)

    def _leaf(self, s: str, at: int) -> int:
        self.next.append({})
        self.seen.append({})
        self.ends.append(0)
        self.total.append(1)
        self.rest.append((s, at))
        return len(self.next) - 1

    def _insert(self, state: int, s: str, at: int) -> None:
        """Let one more string, from a place in it, pass from the state on."""
        for i in range(at, len(s)):
            c = s[i]
            self._open(state)
            self.total[state] += 1
            self.seen[state][c] = self.seen[state].get(c, 0) + 1
            if c not in self.next[state]:
                self.next[state][c] = self._leaf(s, i + 1)
                return
            state = self.next[state][c]
        self._open(state)
        self.total[state] += 1
        self.ends[state] += 1

    def _differs(self, a: int, b: int, of_a: int, of_b: int) -> bool:
        n, m = self.total[a], self.total[b]
        return abs(of_a / n - of_b / m) > self.slack * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _alike(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self.total[a] <= 1 or self.total[b] <= 1:
                continue
            if self._differs(a, b, self.ends[a], self.ends[b]):
                return False
            for c in self.seen[a].keys() | self.seen[b].keys():
                if self._differs(a, b, self.seen[a].get(c, 0), self.seen[b].get(c, 0)):
                    return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the states from ``a`` on."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self.rest[b] is not None:
                self._insert(a, *self.rest[b])
                self.rest[b] = None
                continue
            self._open(a)
            self.ends[a] += self.ends[b]
            self.total[a] += self.total[b]
            for c, n in self.seen[b].items():
                self.seen[a][c] = self.seen[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_all(self) -> None:
        kept = [0]
        while True:
            fringe = sorted(
                {(-self.total[t], s, c) for s in kept for c, t in self.next[s].items() if t not in kept})
            if not fringe:
                break
            _, s, c = fringe[0]
            state = self.next[s][c]
            twin = next((k for k in kept if self._alike(k, state)), None)
            if twin is None:
                self._open(state)
                kept.append(state)
            else:
                self.next[s][c] = twin
                self._fold(twin, state)
        self.states = len(kept)
        place = {k: i for i, k in enumerate(kept)}
        self.next = [{c: place[t] for c, t in self.next[k].items()} for k in kept]
        self.seen, self.ends, self.total = ([x[k] for k in kept] for x in (self.seen, self.ends, self.total))
        self.rest = [None] * len(kept)

    def bits(self, s: str) -> float:
        """Log2 likelihood of the string by symbol, its end included."""
        state, sum_ = 0, 0.0
        for c in s:
            n = self.seen[state].get(c, 0) if state is not None else 0
            sum_ += math.log2(n / self.total[state]) if n else FLOOR
            state = self.next[state].get(c) if state is not None and n else None
        end = self.ends[state] if state is not None else 0
        return (sum_ + (math.log2(end / self.total[state]) if end else FLOOR)) / (len(s) + 1)


class Pairs:
    """How likely a string is as ordinary text: counts of symbol pairs, one added to each.

    A string that the counts come from is judged by what the others contributed. With ``counts``
    of pairs instead of strings, every string that is judged must be one of those counted.
    """

    def __init__(self, strings: list[str] = (), symbols: int = 67, counts: dict[str, int] | None = None) -> None:
        self.own = set(strings)
        self.all_own = counts is not None
        self.pair: dict[str, int] = dict(counts or {})
        self.one: dict[str, int] = {}
        self.symbols = symbols
        for ab, n in self.pair.items():
            self.one[ab[0]] = self.one.get(ab[0], 0) + n
        for s in self.own:
            for a, b in zip(" " + s, s + " "):
                self.pair[a + b] = self.pair.get(a + b, 0) + 1
                self.one[a] = self.one.get(a, 0) + 1

    def bits(self, s: str) -> float:
        steps = [a + b for a, b in zip(" " + s, s + " ")]
        pair, one = (Counter(steps), Counter(x[0] for x in steps)) if self.all_own or s in self.own else ({}, {})
        got = [
            (self.pair.get(x, 0) - pair.get(x, 0) + 1) / (self.one.get(x[0], 0) - one.get(x[0], 0) + self.symbols)
            for x in steps]
        return sum(map(math.log2, got)) / len(steps)


class Format:
    """One kind of credential: its automaton, how its lengths spread, and the least likelihood to pass.

    The logarithm of a length counts as normally distributed, which adds to a string's likelihood.
    No length is ruled out: a format of one length makes others unlikely, one of many lengths
    hardly cares, and the longer a string the more its symbols decide.
    """

    def __init__(self, strings: list[str]) -> None:
        self.automaton = Automaton(strings)
        logs = [math.log(max(len(s), 1)) for s in strings]
        self.mean = sum(logs) / len(logs)
        self.spread = max(0.1, math.sqrt(sum((x - self.mean) ** 2 for x in logs) / len(logs)))
        scores = sorted(map(self.bits, strings))
        self.least = scores[len(scores) // 100] - 0.1

    def bits(self, s: str) -> float:
        """Log2 likelihood by symbol, that of the length included."""
        away = (math.log(max(len(s), 1)) - self.mean) / self.spread
        return self.automaton.bits(s) - away * away / 2 * math.log2(math.e) / (len(s) + 1)

    def accepts(self, s: str, ordinary: Pairs, margin: float) -> bool:
        bits = self.bits(s)
        return bits >= self.least and bits >= ordinary.bits(s) + margin
