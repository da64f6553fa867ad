"""Hashes of byte ranges and words in numpy, the same on every worker.

A byte is mapped to a fixed random number; a range hashes to the sum of its numbers times powers of an odd
base, modulo 2^64, taken from a running sum, so hashing every range of a text costs one pass.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
BLOCK = 1 << 20


def byte_numbers(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base^0 to base^(count - 1)."""
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Powers:
    """Powers of the base and its inverse, kept for the longest text so far."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def of(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            self.up, self.down = powers(BASE, count), powers(INVERSE, count)
        return self.up[:count], self.down[:count]


class Ranges:
    """Hashes of ranges of one text, whose symbols stand for ``values``."""

    def __init__(self, values: np.ndarray, known: Powers | None = None):
        up, self.back = (known or Powers()).of(len(values) + 1)
        self.sums = np.empty(len(values) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        plain = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(plain + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


# ASCII space and U+0009 to U+000D divide words; A to Z are lower-cased.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_NUMBERS = byte_numbers(1)[_LOWER]


def word_hashes(text: bytes, known: Powers | None = None) -> np.ndarray:
    """A hash per word of ``text``, in order. Long texts are taken in blocks that end between words."""
    raw, known = np.frombuffer(text, np.uint8), known or Powers()
    if len(raw) <= BLOCK:
        return _block_words(raw, known)
    found, start = [], 0
    while start < len(raw):
        end = min(len(raw), start + BLOCK)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        found.append(_block_words(raw[start:end], known))
        start = end
    return np.concatenate(found)


def _block_words(raw: np.ndarray, known: Powers) -> np.ndarray:
    inside = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return Ranges(_NUMBERS[raw], known).of(edges[::2], edges[1::2])


def shingles(text: bytes, words: int, known: Powers | None = None) -> np.ndarray:
    """The sorted distinct hashes of runs of ``words`` words; of all words, if they are fewer."""
    hashes = word_hashes(text, known)
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        total = mixed(total + hashes[i : len(hashes) - width + 1 + i] + np.uint64(2 * i + 1))
    return np.unique(total + np.uint64(width))
