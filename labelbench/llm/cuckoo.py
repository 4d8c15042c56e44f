"""Exact deduplication with a cuckoo-filter index of live digests.

The index is a table with one row per bucket of digests: a cuckoo filter, and the digests
themselves (the bucketed content). A digest that misses the filter is new without a look at the
content; a hit is verified against it. Deleting takes the digest from both. A filter that overflows
is rebuilt at twice the size from the stored digests.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelbench.shared import cut

DIGEST = 32
KEYS_PER_BUCKET = 4096
SALTS = 16
SLOTS = 4
KICKS = 200
INDEX = "bucket long, filter binary, digests binary"


class CuckooFilter:
    """16-bit fingerprints in cells of four slots; either of two cells may hold one."""

    def __init__(self, cells: int = 64, slots: bytearray | None = None):
        self.cells = cells  # a power of two
        self.slots = slots if slots is not None else bytearray(2 * SLOTS * cells)

    def _places(self, digest: bytes) -> tuple[bytes, int, int]:
        mark = digest[:2] if digest[:2] != b"\0\0" else b"\0\1"
        home = int.from_bytes(digest[2:10], "little") & (self.cells - 1)
        return mark, home, self._other(home, mark)

    def _other(self, cell: int, mark: bytes) -> int:
        return cell ^ (int.from_bytes(mark, "little") * 0x5BD1E995 >> 5 & (self.cells - 1))

    def _find(self, cell: int, mark: bytes) -> int:
        first = 2 * SLOTS * cell
        for at in range(first, first + 2 * SLOTS, 2):
            if self.slots[at : at + 2] == mark:
                return at
        return -1

    def __contains__(self, digest: bytes) -> bool:
        mark, one, two = self._places(digest)
        return self._find(one, mark) >= 0 or self._find(two, mark) >= 0

    def insert(self, digest: bytes) -> bool:
        """False when no slot was found; the filter must then be rebuilt larger."""
        mark, one, two = self._places(digest)
        for cell in (one, two):
            at = self._find(cell, b"\0\0")
            if at >= 0:
                self.slots[at : at + 2] = mark
                return True
        cell = two
        for kick in range(KICKS):
            at = 2 * SLOTS * cell + 2 * (kick % SLOTS)
            mark, self.slots[at : at + 2] = bytes(self.slots[at : at + 2]), mark
            cell = self._other(cell, mark)
            at = self._find(cell, b"\0\0")
            if at >= 0:
                self.slots[at : at + 2] = mark
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, one, two = self._places(digest)
        for cell in (one, two):
            at = self._find(cell, mark)
            if at >= 0:
                self.slots[at : at + 2] = b"\0\0"
                return True
        return False


class Bucket:
    """The live digests of one bucket behind their filter."""

    def __init__(self, filter_bytes: bytes | None = None, digests: bytes | None = None):
        digests = digests or b""
        self.live = {digests[i : i + DIGEST]: None for i in range(0, len(digests), DIGEST)}
        if filter_bytes:
            self.filter = CuckooFilter(len(filter_bytes) // (2 * SLOTS), bytearray(filter_bytes))
        else:
            self.filter = CuckooFilter()

    def __contains__(self, digest: bytes) -> bool:
        return digest in self.filter and digest in self.live

    def insert(self, digest: bytes) -> bool:
        """True when the digest is new."""
        if digest in self:
            return False
        self.live[digest] = None
        if not self.filter.insert(digest):
            self._grow()
        return True

    def _grow(self) -> None:
        cells = self.filter.cells
        whole = False
        while not whole:
            cells *= 2
            self.filter = CuckooFilter(cells)
            whole = all(map(self.filter.insert, self.live))

    def delete(self, digest: bytes) -> bool:
        if digest not in self:
            return False
        del self.live[digest]
        self.filter.delete(digest)
        return True

    def row(self, bucket: int) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "bucket": [bucket],
                "filter": [bytes(self.filter.slots)],
                "digests": [b"".join(self.live)],
            }
        )


def bucket_of(digest: str | Column, buckets: int) -> Column:
    digest = F.col(digest) if isinstance(digest, str) else digest
    return F.pmod(F.xxhash64(digest), F.lit(buckets)).cast("bigint")


def _changed(index: DataFrame | None, digests: DataFrame, buckets: int, change) -> DataFrame:
    """The index after ``change(bucket, digest)`` for each distinct digest."""
    batch = digests.select("digest").distinct().withColumn("bucket", bucket_of("digest", buckets))
    if index is None:
        index = digests.sparkSession.createDataFrame([], INDEX)

    def run(key, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        state = Bucket(*old.loc[0, ["filter", "digests"]]) if len(old) else Bucket()
        for digest in new["digest"]:
            change(state, digest)
        return state.row(key[0])

    return index.groupBy("bucket").cogroup(batch.groupBy("bucket")).applyInPandas(run, INDEX)


def insert(index: DataFrame | None, digests: DataFrame, buckets: int) -> DataFrame:
    """The index with all ``digest`` values live. None stands for an empty index."""
    return _changed(index, digests, buckets, Bucket.insert)


def delete(index: DataFrame, digests: DataFrame, buckets: int) -> DataFrame:
    """The index without the given digests; unknown ones change nothing."""
    return _changed(index, digests, buckets, Bucket.delete)


def lookup(index: DataFrame, digests: DataFrame, buckets: int) -> DataFrame:
    """``digest``, ``live`` for each distinct digest."""
    batch = digests.select("digest").distinct().withColumn("bucket", bucket_of("digest", buckets))

    def run(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        state = Bucket(*old.loc[0, ["filter", "digests"]]) if len(old) else Bucket()
        return pd.DataFrame({"digest": new["digest"], "live": [d in state for d in new["digest"]]})

    return (
        index.groupBy("bucket")
        .cogroup(batch.groupBy("bucket"))
        .applyInPandas(run, "digest binary, live boolean")
    )


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entries of one bucket through its index: one row per live digest, its entries combined."""
    state, best = Bucket(), {}
    for digest, chars, doc, rows in zip(pdf["digest"], pdf["chars"], pdf["doc"], pdf["rows"]):
        if state.insert(digest):
            best[digest] = (-chars, doc, rows)
        else:
            had = best[digest]
            best[digest] = (*min(had[:2], (-chars, doc)), had[2] + rows)
    return pd.DataFrame(
        {
            "digest": list(best),
            "keep": [b[1] for b in best.values()],
            "group_size": [b[2] for b in best.values()],
        }
    )


def squeezed(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in " \t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def exact_duplicates(docs: DataFrame, keys_per_bucket: int = KEYS_PER_BUCKET) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` for every row of ``docs``.

    Texts are equal when they agree without ASCII white space; null counts as empty. Of equal texts
    the longest original stays, then the smallest doc_id, null last. Of rows that also agree in
    doc_id one stays. No rows give no rows.

    Copies shrink before they meet: to one entry per digest and salt, so no bucket of the index
    holds a large group. The join back to the rows is one that Spark splits when a digest is hot.
    """
    text, nobody = squeezed(F.col("text")), F.lit(2**63 - 1)
    once = Window.partitionBy("digest", "doc_id").orderBy(F.desc("chars"))
    rows = cut(
        docs.select(
            "doc_id",
            F.coalesce(F.char_length("text"), F.lit(0)).alias("chars"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ).withColumn("first", F.row_number().over(once) == 1)
    )
    entries = (
        rows.withColumn("doc", F.coalesce("doc_id", nobody))
        .groupBy("digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
        .agg(
            F.max("chars").alias("chars"),
            F.max_by(-F.col("doc"), F.struct("chars", -F.col("doc"))).alias("doc"),
            F.count(F.lit(1)).alias("rows"),
        )
        .withColumn("doc", -F.col("doc"))
    )
    buckets = max(1, rows.count() // keys_per_bucket)
    groups = (
        entries.withColumn("bucket", bucket_of("digest", buckets))
        .groupBy("bucket")
        .applyInPandas(_merged, "digest binary, keep long, group_size long")
    )
    return rows.join(groups, "digest").select(
        "doc_id",
        F.nullif("keep", nobody).alias("keep_id"),
        "group_size",
        (F.col("first") & (F.coalesce("doc_id", nobody) == F.col("keep"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
