"""Texts of Arrow batches as bytes, in runs of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """UTF-8 of each text; null becomes empty."""
    return pc.fill_null(column(batch, name).cast(pa.large_string()), "").cast(pa.large_binary())


def runs(batch: pa.RecordBatch, limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows with at most ``limit`` bytes of text, or of one row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column(batch, name)), 0), np.int64)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def give_back() -> None:
    """Return what this worker process has freed to the system.

    A worker lives on from task to task, and keeps the most it ever held unless told to return it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # there with glibc only
    if trim is not None:
        trim(0)
