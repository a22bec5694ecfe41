"""The binary Golay code (23, 12, 7) as fuzzy keys of short bit segments.

Every 23-bit word lies within 3 bits of exactly one code word, so the decoded
index of a word and of its neighbours one bit away are its keys: two words
within 2 bits of each other share a neighbour, hence a key.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

# Length, dimension and generator polynomial of the code.
LENGTH, DIMENSION = 23, 12
GENERATOR = 0b101011100011

CHECK = LENGTH - DIMENSION


def _remainder(word: np.ndarray) -> np.ndarray:
    """Word modulo the generator polynomial over GF(2): its syndrome."""
    word = word.copy()
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        word ^= ((word >> bit) & 1) * (GENERATOR << (bit - CHECK))
    return word


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """Syndrome -> the one error pattern of at most 3 bits that has it."""
    patterns = np.array([sum(1 << b for b in c) for k in range(4) for c in combinations(range(LENGTH), k)], np.int64)
    table = np.full(1 << CHECK, -1, np.int64)
    table[_remainder(patterns)] = patterns
    return table


def decode(words: np.ndarray) -> np.ndarray:
    """Index (the 12 leading bits) of the code word nearest to each 23-bit word."""
    return (words ^ _errors()[_remainder(words)]) >> CHECK


def keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of segments of ``width`` bits (at most 22: zeros fill the word): first place, count, and all keys, ascending in each segment."""
    found = np.empty((len(words), width + 1), np.int16)
    found[:, 0] = decode(words)
    syndrome = _remainder(words)
    for bit in range(width):
        flip = np.array([1 << bit])
        found[:, bit + 1] = (words ^ flip ^ _errors()[syndrome ^ _remainder(flip)]) >> CHECK
    found.sort(axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    count = fresh.sum(axis=1)
    return np.cumsum(count) - count, count, found[fresh]
