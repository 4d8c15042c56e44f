"""Distinct five-word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

WIDTH = 5
SPACES = b" \t\n\x0b\x0c\r"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    forward = np.full(n, base, np.uint64)
    back = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    forward[0] = back[0] = 1
    return np.multiply.accumulate(forward), np.multiply.accumulate(back)


# Bytes are spread over 64 bits first; A-Z count as a-z, white space as nothing.
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_SPREAD = mixed((_LOWER + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_IS_SPACE = np.isin(np.arange(256), list(SPACES))
_SPREAD[_IS_SPACE] = 0


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(row of each shingle, its hash), sorted by row and hash, distinct within a row.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text with fewer than
    ``width`` words has one shingle, all its words; one without words has none.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)  # every text ends in a space
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _IS_SPACE[data]
    inside = ~space
    first = np.flatnonzero(inside & np.concatenate([[True], space[:-1]]))
    after = np.flatnonzero(space & np.concatenate([[False], inside[:-1]]))
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # A word's hash: sum of spread bytes times powers of their places, from prefix sums.
    forward, back = odd_powers(len(data))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_SPREAD[data] * forward)])
    words = mixed((sums[after] - sums[first]) * back[first] + (after - first).astype(np.uint64))
    row = np.searchsorted(ends, first, side="right")
    counts = np.bincount(row, minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    # Places of shingles: up to (words - width + 1) in a row, one if there are fewer words.
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    owner = np.repeat(np.arange(len(texts)), shingles)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    at = starts[owner] + place
    left = (starts + counts)[owner] - at
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    hashes = np.zeros(len(at), np.uint64)
    for i in range(width):
        word = np.where(i < left, padded[at + i], np.uint64(0))
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + word
    hashes = mixed(hashes)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]
