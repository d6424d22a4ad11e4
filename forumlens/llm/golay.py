"""The binary Golay code as a fuzzy hash.

The (23, 12) code has 4096 codewords with distance 7 between any two, and every
23-bit word lies within distance 3 of exactly one. That codeword's index is the
word's own key. The words within distance 4 of a word's own codeword, seen from
the other side, give each word one key or six. If two words differ in one bit,
the own key of either is among the keys of the other: its codeword is at most 3
from the one and so at most 4 from the other.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS = 23
#: Fixed value: the generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: The most keys a word has.
KEYS = 6


def _remainder(word: int) -> int:
    for shift in range(BITS - 1, 10, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - 11)
    return word


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The remainder of each single bit, and by remainder the error patterns of weight 4 or less."""
    single = np.array([_remainder(1 << b) for b in range(BITS)], dtype=np.int64)
    patterns = np.full((1 << 11, KEYS), -1, dtype=np.int64)
    used = np.zeros(1 << 11, dtype=np.int64)
    for weight in range(5):
        for places in combinations(range(BITS), weight):
            remainder = 0
            for b in places:
                remainder ^= int(single[b])
            patterns[remainder, used[remainder]] = sum(1 << b for b in places)
            used[remainder] += 1
    return single, patterns


def keys(words: np.ndarray) -> np.ndarray:
    """An array of six keys per 23-bit word; the first is its own, missing ones are -1.

    Higher bits are no part of a word and do not change its keys.
    """
    single, patterns = _tables()
    words = words & ((1 << BITS) - 1)
    remainder = np.zeros(words.shape, dtype=np.int64)
    for b in range(BITS):
        remainder ^= np.where(words >> b & 1, single[b], 0)
    errors = patterns[remainder]
    # The upper 12 bits of a codeword tell it
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1)
