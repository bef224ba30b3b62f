"""Words and word sequences of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than space and U+0009 to U+000D.  Word hashes come from running sums
of a polynomial over the bytes, sequence hashes from one over the word hashes; both end in a mixer.
"""

from __future__ import annotations

import numpy as np

_GAP = np.zeros(256, bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that leaves no visible structure."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``.

    ``start`` and ``end`` are byte places; words ``first[i]`` to ``first[i + 1] - 1`` are text i's.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~_GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, lower: bool = False) -> np.ndarray:
        data = _LOWER[self.data] if lower else self.data
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
        inverse = _powers(_BASE_INVERSE, len(data) + 1)
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


def sequences(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of ``k`` consecutive words, by the first word's place; some cross from text to text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for t in range(1, k):
        out = out * _STEP + hashes[t : t + n]
    return mix(out, k)


def shingle_sets(words: Words, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text and their n+1 offsets; a text of fewer words is one shingle."""
    hashes, counts = words.hashes(lower), words.counts
    whole = sequences(hashes, k)
    take = np.maximum(counts - k + 1, 0)
    owner = np.repeat(np.arange(len(counts)), take)
    place = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take) + np.repeat(words.first[:-1], take)
    found = whole[place] if len(place) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        single = np.array([sequences(hashes[words.first[i] : words.first[i + 1]], int(counts[i]))[0] for i in short], np.uint64)
        found, owner = np.concatenate([found, single]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(counts) + 1))
