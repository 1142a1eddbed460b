"""Hashes of word shingles, computed on whole texts with numpy.

Words are runs of bytes other than space and 09-0D, with A-Z lowered. A text with fewer words than a shingle has
its whole sequence as one; a text without words has none.
"""

from __future__ import annotations

import hashlib

import numpy as np

WORDS_PER_SHINGLE = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = np.random.default_rng(20_240_229).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers without visible pattern."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word, in order."""
    data = np.frombuffer(text.encode(), np.uint8)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    powers, inverse = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[_LOWER[data]] * powers[:len(data)])])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _ODD)


def shingle_set(text: str | None, size: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; empty for a null."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    k = min(size, len(words))
    out = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        out = out * _ODD + words[i:len(words) - k + 1 + i]
    # A short sequence is no prefix of a longer one.
    return np.unique(mix(out + np.uint64(k)))


def digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
