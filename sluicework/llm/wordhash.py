"""Hashes of all words of many texts at once, without a Python loop over words."""

from __future__ import annotations

import numpy as np

# A random odd base, and a random number for each byte; A-Z count as a-z.
BASE = np.uint64(0xD6E8FEB86659FD93)
BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)
BYTES[ord("A"):ord("Z") + 1] = BYTES[ord("a"):ord("z") + 1]
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int, base: np.uint64) -> np.ndarray:
    table = np.full(count, base, dtype=np.uint64)
    table[:1] = 1
    return np.multiply.accumulate(table)


def word_spans(texts: list[str], breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, hashes, words of each text) of all words of texts, cut at the bytes in ``breaks``.

    A line feed must be a break.  A word's hash is the sum of byte number times
    power of the base over its bytes, modulo 2**64, taken from running sums and
    then scrambled.
    """
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(coded) + b"\n", dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], breaks[data]]).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTES[data] * powers(len(data), BASE), dtype=np.uint64)])
    hashes = scramble((sums[ends] - sums[starts]) * powers(len(data), inverse)[starts])
    borders = np.cumsum([0] + [len(c) + 1 for c in coded])
    return data, starts, ends, hashes, np.diff(np.searchsorted(starts, borders))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text)."""
    return word_spans(texts)[3:]
