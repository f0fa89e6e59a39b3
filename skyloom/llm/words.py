"""Word hashes of whole UTF-8 batches, in numpy."""

from __future__ import annotations

import numpy as np

from skyloom.llm.common import U64, mix

_TABLE = np.random.default_rng(20240611).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_TABLE[65:91] = _TABLE[97:123]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of the words [^\\x20\\x09-\\x0D]+; no word crosses a row."""
    return runs(data, offsets, _SPACE)


def runs(data: np.ndarray, offsets: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of the runs of bytes that the table `between` doesn't mark."""
    word = ~between[data]
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return e, e, e
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:n]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[s:e], A-Z as a-z."""
    n = len(data)
    with np.errstate(over="ignore"):
        powers = np.multiply.accumulate(np.full(n + 1, _BASE, np.uint64))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * powers[:n], out=total[1:])
        h = total[e] - total[s]
        down = np.multiply.accumulate(np.full(n + 1, _INVERSE, np.uint64))
        h *= down[s]
        return mix(h + (e - s).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles of `size` words; fewer words make one shingle, none an empty set."""
    s, e, row = word_bounds(data, offsets)
    h = word_hashes(data, s, e)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    rolled = np.zeros(max(0, len(h) - size + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size if len(rolled) else 0):
            rolled += mix(h[j : j + len(rolled)] + U64(j)) * _ODD[j % 5]
        rolled = mix(rolled)
        out = []
        for i in range(rows):
            a, b = first[i], first[i + 1]
            if b - a >= size:
                out.append(np.unique(rolled[a : b - size + 1]))
            elif b > a:
                w = h[a:b]
                out.append(mix(np.array([np.sum(mix(w + np.arange(b - a, dtype=np.uint64)) * np.resize(_ODD, b - a))], np.uint64) + U64(int(b - a))))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
