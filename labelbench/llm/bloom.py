"""Bloom filters over 64-bit hashes, one per slice of the hash space, sent as one array."""

from __future__ import annotations

import numpy as np

BITS_PER_KEY = 12
PROBES = 4
SENT_BYTES = 64 << 20  # of all filters that may be sent to the tasks


def bits_for(keys: int) -> int:
    return 1 << max(6, (keys * BITS_PER_KEY - 1).bit_length())


def positions(hashes: np.ndarray, bits) -> np.ndarray:
    """``PROBES`` positions below ``bits``, a power of two, for each hash."""
    step = (hashes >> np.uint64(17)) | np.uint64(1)
    mask = np.asarray(bits, np.uint64) - np.uint64(1)
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    return np.stack([((mixed + np.uint64(i) * step) >> np.uint64(13)) & mask for i in range(PROBES)])


def packed(hashes: np.ndarray) -> bytes:
    """A filter of its own size for distinct hashes."""
    bits = np.zeros(bits_for(len(hashes)), bool)
    bits[positions(hashes, len(bits))] = True
    return np.packbits(bits, bitorder="little").tobytes()


def slice_count(amount: int, per_slice: int = 4096) -> int:
    return 1 << max(0, int(amount // per_slice).bit_length())


def by_slice(hashes: np.ndarray, slices: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(slices that occur, the indices of each one's hashes)."""
    at = (hashes & np.uint64(slices - 1)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    names, starts = np.unique(at[order], return_index=True)
    return names, np.split(order, starts[1:]) if len(names) else []


def joined(slices: int, rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (slice, packed) as (packed bits, first bit of each slice, bits of each slice)."""
    start, bits = np.zeros(slices, np.int64), np.full(slices, 64, np.uint64)
    parts, at = [bytes(8)], 8
    for row in rows:
        start[row["slice"]] = at * 8
        bits[row["slice"]] = len(row["packed"]) * 8
        parts.append(bytes(row["packed"]))
        at += len(row["packed"])
    return np.frombuffer(b"".join(parts), np.uint8), start, bits


def maybe_in(filters: tuple, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that no filter holds."""
    all_bits, start, bits = filters
    at = (hashes & np.uint64(len(start) - 1)).astype(np.int64)
    bit = start[at] + positions(hashes, bits[at]).astype(np.int64)
    return ((all_bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).all(axis=0)
