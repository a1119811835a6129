"""The perfect binary Golay code of 23 bits, on numpy arrays of words.

Every 23-bit word is within three bits of exactly one of the 4096 codewords.
`neighbour_keys` decodes a word and all words one bit away; two words that
differ in at most two bits have such a neighbour in common, so they share a key.
A word has one key or six.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

#: Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
BITS = 23
CHECKS = 11


@lru_cache
def _remainders() -> tuple[np.ndarray, np.ndarray]:
    """Remainders by the generator of the lower and of the upper 12 bits."""
    single = []
    value = 1
    for _ in range(BITS):
        single.append(value)
        value <<= 1
        if value >> CHECKS & 1:
            value ^= GENERATOR
    halves = []
    for bits in (single[:12], single[12:]):
        table = np.zeros(1, dtype=np.int64)
        for rest in bits:
            table = np.concatenate([table, table ^ rest])
        halves.append(table)
    return halves[0], halves[1]


def syndrome(words: np.ndarray) -> np.ndarray:
    low, high = _remainders()
    return low[words & 0xFFF] ^ high[words >> 12]


@lru_cache
def _errors() -> np.ndarray:
    """The error of at most three bits behind each syndrome."""
    table = np.full(1 << CHECKS, -1, dtype=np.int64)
    for n in range(4):
        for places in combinations(range(BITS), n):
            error = sum(1 << p for p in places)
            table[syndrome(np.array([error]))[0]] = error
    return table


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12 message bits of the nearest codeword."""
    return (words ^ _errors()[syndrome(words)]) >> CHECKS


def neighbour_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which word, codeword index) for the distinct indices near each word."""
    flips = np.concatenate([[0], 1 << np.arange(BITS)])
    found = np.sort(codeword_index(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new]
