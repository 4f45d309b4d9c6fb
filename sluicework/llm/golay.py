"""The binary Golay code of length 23, as far as fuzzy hashing needs it.

Every 23-bit word lies within distance 3 of exactly one codeword.  Extended by
its parity bit, a word at distance 3 has six codewords at distance 4, the rest
have one nearer one.  Two words that differ in at most two bits always share
one of these codewords, so the codewords' message bits serve as hash keys.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH = 23
MESSAGE = 12
CHECK = LENGTH - MESSAGE
# Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the code.
GENERATOR = 0b110001110101


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders by the generator."""
    rest = words.astype(np.int64) & ((1 << LENGTH) - 1)
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK)), rest)
    return rest


@lru_cache(maxsize=1)
def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: up to six error patterns that lead to near codewords, and how many there are."""
    patterns = np.zeros((1 << CHECK, 6), dtype=np.int64)
    counts = np.zeros(1 << CHECK, dtype=np.int64)
    weights = np.zeros(1 << CHECK, dtype=np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(LENGTH), weight)], dtype=np.int64)
        for error, syndrome in zip(errors.tolist(), syndromes(errors).tolist(), strict=True):
            if weight == 4 and weights[syndrome] < 3:
                continue
            patterns[syndrome, counts[syndrome]] = error
            counts[syndrome] += 1
            weights[syndrome] = weight if counts[syndrome] == 1 else weights[syndrome]
    return patterns, counts


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Message bits of the near codewords of each word: an (n, 6) array and how many of a row count."""
    patterns, counts = error_patterns()
    syndrome = syndromes(words)
    return (words.astype(np.int64)[:, None] ^ patterns[syndrome]) >> CHECK, counts[syndrome]
