"""Suffix sorting by hash comparison, and the units that shared strings are searched by."""

from __future__ import annotations

import numpy as np

from .hashing import mix, powers, prefix_hashes, span_hashes


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    low, have = values, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def units(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of ``length``-byte windows with the same least gram hash.

    Returns (text, start, windows, anchor, unit): ``anchor`` is the gram's hash and ``unit`` that
    of all bytes the run covers. Equal windows have equal anchors, wherever they stand, so a
    string of ``length`` bytes that two texts share lies in units of one anchor.
    """
    size = np.array([len(t) for t in texts], np.int64)
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return none
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - gram + 1)
    low = window_minima(mix((prefix[gram:] - prefix[: len(at)]) * powers(len(at))[1]), length - gram + 1)
    end = np.cumsum(size)
    text = np.repeat(np.arange(len(texts)), size)[: len(low)]
    inside = end[text] - np.arange(len(low)) >= length
    cut = np.flatnonzero((low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])) + 1
    start = np.concatenate([[0], cut])
    windows = np.diff(np.concatenate([start, [len(low)]]))
    keep = inside[start]
    start, windows = start[keep], windows[keep]
    if not len(start):
        return none
    unit = mix(span_hashes(prefix, start, start + windows - 1 + length) + windows.astype(np.uint64))
    return text[start], start - (end - size)[text[start]], windows, low[start], unit


class Suffixes:
    """Suffixes of a byte string, compared over at most ``depth`` bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, depth: int) -> None:
        self.data, self.starts, self.depth = data, starts, depth
        self.prefix = prefix_hashes(data)
        self.power = powers(len(data) + 1)[0]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes at bytes ``a`` and ``b``: a binary search on hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.depth)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = ((self.prefix[a + mid] - self.prefix[a]) * self.power[b]
                    == (self.prefix[b + mid] - self.prefix[b]) * self.power[a])
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        n = self.common(a, b)
        k = np.minimum(n, self.depth - 1)
        differs = n < self.depth
        return np.where(differs, self.data[a + k] < self.data[b + k], or_equal)

    def order(self, group: np.ndarray) -> np.ndarray:
        """Places of the suffixes sorted within each group; ``group`` is sorted.

        A bottom-up mergesort of all groups at once: a suffix's place in the merged run is its
        own place plus its rank in the other run, found by binary search.
        """
        n = len(self.starts)
        out = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else out
        begin = np.repeat(first, np.diff(np.concatenate([first, [n]])))
        end = np.repeat(np.concatenate([first[1:], [n]]), np.diff(np.concatenate([first, [n]])))
        width, largest = 1, int((end - begin).max()) if n else 0
        while width < largest:
            place = np.arange(n)
            run = (place - begin) // width
            right = run % 2 == 1
            other = np.where(right, begin + (run - 1) * width, begin + (run + 1) * width)
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            base = low.copy()
            todo = np.flatnonzero(low < high)
            while len(todo):
                mid = (low[todo] + high[todo]) // 2
                mine, theirs = self.starts[out[place[todo]]], self.starts[out[mid]]
                # Equal suffixes of the left run come first.
                before = np.where(
                    right[todo], self.less(theirs, mine, or_equal=True), self.less(theirs, mine, or_equal=False))
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
                todo = todo[low[todo] < high[todo]]
            start = np.where(right, other, begin + run * width)
            target = start + (place - (begin + run * width)) + (low - base)
            merged = np.empty_like(out)
            merged[target] = out
            out, width = merged, width * 2
        return out

    def same_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the ``depth`` bytes at ``a`` and ``b`` are equal, byte by byte."""
        out = np.ones(len(a), bool)
        for k in range(self.depth):
            out &= self.data[a + k] == self.data[b + k]
        return out


def equal_classes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, class): the suffixes whose ``depth`` bytes occur again in their group, sorted.

    Neighbours in ``order`` of one class have equal bytes. Suffixes whose hash is alone are left
    out. Of those with equal hashes one is sorted for all: dealt by the first 16 bytes, then
    mergesorted. Every pair of neighbours in a class is verified on the bytes.
    """
    none = np.empty(0, np.int64)
    suffixes = Suffixes(data, starts, depth)
    whole = mix(span_hashes(suffixes.prefix, starts, starts + depth) ^ mix(group.astype(np.uint64)))
    by_hash = np.argsort(whole, kind="stable")
    same = whole[by_hash][1:] == whole[by_hash][:-1]
    again = np.zeros(len(starts), bool)
    again[by_hash[1:][same]] = again[by_hash[:-1][same]] = True
    by_hash = by_hash[again[by_hash]]
    if not len(by_hash):
        return none, none
    first = np.concatenate([[True], whole[by_hash][1:] != whole[by_hash][:-1]])
    heads, member_of = by_hash[first], np.cumsum(first) - 1

    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = []
    for k in (0, 8):
        key = np.zeros(len(heads), np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | padded[starts[heads] + k + i].astype(np.uint64)
        words.append(key)
    dealt = np.lexsort((words[1], words[0], group[heads]))
    changed = np.zeros(len(heads), bool)
    for x in (words[1][dealt], words[0][dealt], group[heads][dealt]):
        changed[1:] |= x[1:] != x[:-1]
    sorted_heads = dealt[Suffixes(data, starts[heads][dealt], depth).order(np.cumsum(changed))]
    rank = np.empty(len(heads), np.int64)
    rank[sorted_heads] = np.arange(len(heads))
    order = by_hash[np.argsort(rank[member_of], kind="stable")]
    class_ = np.sort(rank[member_of])

    alike = np.flatnonzero(class_[1:] == class_[:-1])
    if not suffixes.same_bytes(starts[order[alike]], starts[order[alike + 1]]).all():
        # Hashes collided: the bytes themselves decide.
        raw = data.tobytes()
        key = {i: (int(group[i]), raw[starts[i] : starts[i] + depth]) for i in order}
        order = np.array(sorted(order, key=key.__getitem__))
        class_ = np.cumsum([False, *(key[a] != key[b] for a, b in zip(order, order[1:]))])
    return order, class_
