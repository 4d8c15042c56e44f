"""Words of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from labelbench.llm.shingles import mixed, odd_powers

# Digits, letters of ASCII (A-Z as a-z), and all bytes of other characters make words.
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[65:91] = _INSIDE[128:] = True
_SPREAD = mixed((_LOWER + 1).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
_SPREAD[~_INSIDE] = 0


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each word, its hash, its first byte, the byte after it) in order of the texts.

    Bytes are counted inside the word's own text.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)  # every text ends in a space
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    inside = np.append(False, _INSIDE[data])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, after = edges[0::2], edges[1::2]
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint64), none, none
    # A word's hash: sum of spread bytes times powers of their places, from prefix sums.
    forward, back = odd_powers(len(data))
    sums = np.append(np.uint64(0), np.cumsum(_SPREAD[data] * forward))
    hashes = mixed((sums[after] - sums[first]) * back[first] + (after - first).astype(np.uint64))
    row = np.searchsorted(starts, first, side="right") - 1
    return row, hashes, first - starts[row], after - starts[row]
