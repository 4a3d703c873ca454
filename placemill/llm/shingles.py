"""Hashes of substrings of many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 16


@lru_cache(4)
def _powers(base: int, n: int) -> np.ndarray:
    """base ** i mod 2 ** 64 for i < n."""
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, base, np.uint64))])


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, max(_BLOCK, 1 << (n - 1).bit_length()))[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Substrings:
    """Prefix sums of bytes times powers of an odd base: the hash of any substring is one difference and one product."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n + 1)[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.sums[1:])
        self.down = powers(_INVERSE, n + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all substrings of a size, as ``Substrings`` gives them: for blocks that fit the CPU's cache."""
    n = len(data) - size + 1
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= powers(_BASE, len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    h = np.subtract(sums[size:], sums[:n], out=terms[:n])
    h *= powers(_INVERSE, n)
    h += np.uint64(size)
    shifted = np.empty(n, np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= np.right_shift(h, np.uint64(shift), out=shifted)
        h *= np.uint64(factor)
    h ^= np.right_shift(h, np.uint64(31), out=shifted)
    return h


def word_shingles(text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the runs of ``size`` words of an already normalised text (words parted by one space), and how
    often each occurs. A text of fewer words is one shingle; a text without words has none."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(data)]])
    k = min(size, len(starts))
    return np.unique(Substrings(data).hash(starts[:len(starts) - k + 1], ends[k - 1:]), return_counts=True)
