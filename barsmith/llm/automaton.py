"""A minimal acyclic transducer from byte strings to numbers, built from sorted words.

States with the same right language are one state, so words share their endings as well as
their beginnings. Each arc carries how many words come before those behind it; their sum along
a word is the word's number, which is the transducer's output. The automaton is one flat
integer array: it is written to a file, memory-mapped by readers and walked for many words at
a time.
"""

from __future__ import annotations

import numpy as np

HEADER = 4


def compile_words(words: list[bytes], outputs: list[list[int]]) -> np.ndarray:
    """The file's array: sorted distinct ``words``, each with its list of output ids."""
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, label) from the root to the last word's end

    def settle(depth: int) -> None:
        while len(path) > depth:
            state, label = path.pop()
            child = arcs[state][label]
            shape = (final[child], tuple(arcs[child].items()))
            arcs[state][label] = register.setdefault(shape, child)

    last = b""
    for word in words:
        common = next((i for i, (x, y) in enumerate(zip(word, last)) if x != y), min(len(word), len(last)))
        settle(common)
        state = path[-1][0] if path else 0
        state = arcs[state][path[-1][1]] if path else 0
        for label in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[state][label] = len(arcs) - 1
            path.append((state, label))
            state = len(arcs) - 1
        final[state] = True
        last = word
    settle(0)

    # Number the states that are left, and count the words behind each.
    order, number, stack = [], {0: 0}, [0]
    while stack:
        state = stack.pop()
        order.append(state)
        for child in arcs[state].values():
            if child not in number:
                number[child] = len(number)
                stack.append(child)
    below: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        missing = [c for c in arcs[state].values() if c not in below]
        if missing:
            stack.extend(missing)
        else:
            stack.pop()
            below[state] = final[state] + sum(below[c] for c in arcs[state].values())

    rows = []
    for state in order:
        before = int(final[state])
        for label, child in sorted(arcs[state].items()):
            rows.append((number[state] * 256 + label, number[child], before))
            before += below[child]
    rows.sort()
    table = np.array(rows, np.int32).reshape(-1, 3)
    ends = np.zeros(len(number), np.int32)
    ends[[number[s] for s in order if final[s]]] = 1
    offsets = np.cumsum([0, *(len(o) for o in outputs)]).astype(np.int32)
    ids = np.array([i for o in outputs for i in o], np.int32)
    head = np.array([len(table), len(ends), len(offsets), len(ids)], np.int32)
    return np.concatenate([head, table[:, 0], table[:, 1], table[:, 2], ends, offsets, ids])


class Lexicon:
    """Reads what ``compile_words`` made, from memory or a mapped file."""

    def __init__(self, data: np.ndarray) -> None:
        n, states, offsets, ids = (int(x) for x in data[:HEADER])
        cuts = np.cumsum([HEADER, n, n, n, states, offsets, ids])
        self.key, self.target, self.before, self.final, self.offset, self.ids = (
            data[a:b] for a, b in zip(cuts[:-1], cuts[1:]))

    @classmethod
    def open(cls, path: str) -> Lexicon:
        return cls(np.load(path, mmap_mode="r"))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those that aren't in the lexicon."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.key):
            return out
        size = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        alive = np.arange(len(words))
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        depth = 0
        while len(alive):
            done = size[alive] == depth
            ended = alive[done]
            out[ended] = np.where(self.final[state[ended]] == 1, total[ended], -1)
            alive = alive[~done]
            want = state[alive] * 256 + flat[start[alive] + depth]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[at] == want
            alive, at = alive[hit], at[hit]
            state[alive] = self.target[at]
            total[alive] += self.before[at]
            depth += 1
        return out

    def output(self, number: int) -> list[int]:
        return self.ids[self.offset[number] : self.offset[number + 1]].tolist()
