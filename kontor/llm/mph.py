"""A minimal perfect hash over 64-bit numbers, built and read in numpy.

Each level is a bit field of `GAMMA` bits for each number that is left; a number that
falls on a bit alone stays there, the others go to the next level.  The place of a
number is the count of set bits before its bit.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2
WORD_BITS = 64


def mixed(numbers: np.ndarray, seed: int) -> np.ndarray:
    """Another 64-bit number for each, by multiplying and folding."""
    with np.errstate(over="ignore"):
        value = numbers + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
        value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def build(numbers: np.ndarray) -> dict[str, np.ndarray]:
    """`words` (all levels' bits), `ranks` (set bits before each word), `sizes` (bits of each level).

    The numbers must be distinct.
    """
    words, sizes, left = [], [], numbers.astype(np.uint64)
    while len(left):
        size = -(-GAMMA * len(left) // WORD_BITS) * WORD_BITS
        place = mixed(left, len(sizes)) % np.uint64(size)
        alone = np.bincount(place.astype(np.int64), minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone[place]]
    joined = np.concatenate(words) if words else np.zeros(0, "<u8")
    ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(joined))[:-1]]) if words else np.zeros(0)
    return {"words": joined, "ranks": ranks.astype("<i8"), "sizes": np.array(sizes, "<i8")}


def places(table: dict[str, np.ndarray], numbers: np.ndarray) -> np.ndarray:
    """The place of each number; -1 if it falls on no bit, so that it was not built in."""
    numbers = numbers.astype(np.uint64)
    result = np.full(len(numbers), -1, np.int64)
    todo, base = np.arange(len(numbers)), 0
    for seed, size in enumerate(table["sizes"]):
        bit = (mixed(numbers[todo], seed) % np.uint64(size)).astype(np.int64) + base
        word, shift = bit // WORD_BITS, (bit % WORD_BITS).astype(np.uint64)
        found = (table["words"][word] >> shift) & np.uint64(1) == 1
        below = table["words"][word] & ((np.uint64(1) << shift) - np.uint64(1))
        result[todo[found]] = (table["ranks"][word] + np.bitwise_count(below))[found]
        todo, base = todo[~found], base + int(size)
    return result
