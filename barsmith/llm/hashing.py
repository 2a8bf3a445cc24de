"""Numpy helpers for tasks: words and shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_BYTES = np.arange(256, dtype=np.uint8)
SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all others."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


#: One 64-bit value for each byte, so that polynomials don't see small consecutive numbers.
VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * BASE)

_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^0..n-1 and their inverses, kept for the next call."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, BASE, np.uint64), np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of a byte array, one more than it has bytes."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUE[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal bytes have equal hashes wherever they stand."""
    return (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]


def chunks(texts: list[bytes], limit: int = 1 << 19) -> Iterator[slice]:
    """Slices of the list with about ``limit`` bytes each, so that memory stays bounded."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and for each text the first of its words."""
    data = LOWER[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    gap = SPACE[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    hashes = mix(span_hashes(prefix_hashes(data), start, end) + (end - start).astype(np.uint64))
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(start, begin)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole sequence as the only shingle; one without words none.
    """
    out: list[np.ndarray] = []
    for part in chunks(texts):
        words, first = word_hashes(texts[part])
        rolled = words
        for k in range(1, width):
            rolled = mix(rolled[: len(words) - k]) + words[k:]
        rolled = mix(rolled)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                out.append(np.unique(rolled[a : b - width + 1]))
            elif b > a:
                h = words[a : a + 1] + np.uint64(b - a)
                for w in words[a + 1 : b]:
                    h = mix(h) + w
                out.append(mix(h))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def digest(values: np.ndarray) -> bytes:
    return hashlib.md5(values.tobytes()).digest()
