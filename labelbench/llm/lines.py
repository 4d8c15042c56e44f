"""Dropping lines that many documents share, found with two Bloom filters.

Hashes of lines, not lines, are dealt to slices of the hash space. Each slice keeps one filter of
the hashes seen once and one of those seen twice. The second filters travel to the documents, and
only lines that hit them, the suspected repeats, are shuffled to be counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelbench.llm.batches import column, give_back, text_bytes
from labelbench.llm.bloom import SENT_BYTES, bits_for, by_slice, joined, maybe_in, packed, positions, slice_count
from labelbench.shared import cut

SPACES = b" \t\n\x0b\x0c\r"
BYTES_PER_SLICE = 16 << 20  # of text, whose lines leave a few hashes each
SENT_KEYS = 500_000  # confirmed lines that may be sent to the tasks


def line_key(line: bytes) -> bytes:
    """Without ASCII white space at the ends, A-Z in lower case."""
    return line.strip(SPACES).lower()


def line_digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (least <= 1 or len(key.decode()) >= least)


def _hashes(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)[:, 0]


def _slice_filters(pdf: pd.DataFrame) -> pd.DataFrame:
    """The hashes of one slice through both filters; out comes the second, packed."""
    bits = bits_for(sum(map(len, pdf["hashes"])) // 8)
    once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
    for blob in pdf["hashes"]:
        hashes, counts = np.unique(np.frombuffer(blob, "<u8"), return_counts=True)
        at = positions(hashes, bits)
        again = (counts > 1) | once[at].all(axis=0)
        twice[at[:, again]] = True
        once[at] = True
    # Few hashes are in the second filter: they go into one of their own size.
    repeated = [
        hashes[twice[positions(hashes, bits)].all(axis=0)]
        for hashes in (np.frombuffer(blob, "<u8") for blob in pdf["hashes"])
    ]
    return pd.DataFrame(
        {"slice": pdf["slice"].iloc[:1], "packed": [packed(np.unique(np.concatenate(repeated)))]}
    )


def repeat_filters(docs: DataFrame, min_chars: int = 1) -> tuple[DataFrame, int]:
    """(``slice``, ``packed``): the filters of hashes of lines seen in two documents; slice count."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = slice_count(size, BYTES_PER_SLICE)
    schema = pa.schema([("slice", pa.int64()), ("hashes", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in text_bytes(batch):
                keys = set(map(line_key, text.as_py().split(b"\n")))
                found += [line_digest(k) for k in keys if _long_enough(k, min_chars)]
            hashes, counts = np.unique(_hashes(found), return_counts=True)
            hashes = np.concatenate([hashes, hashes[counts > 1]])  # two are as good as more
            names, parts = by_slice(hashes, slices)
            blobs = [hashes[part].tobytes() for part in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(blobs, pa.binary())], schema=schema
            )
        give_back()

    hashes = docs.select("text").mapInArrow(emit, "slice long, hashes binary")
    return (
        hashes.groupBy("slice").applyInPandas(_slice_filters, "slice long, packed binary"),
        slices,
    )


def repeated_lines(
    docs: DataFrame, min_docs: int, min_chars: int = 1, filter_bytes: int = SENT_BYTES
) -> DataFrame:
    """``digest``, ``docs``, ``first`` of the lines found in at least ``min_docs`` documents.

    ``first`` is the smallest (doc_id, line number) with the line. Filters above ``filter_bytes``
    in all are not sent; then every line is counted exactly, with the same result.
    """
    filters, slices = repeat_filters(docs, min_chars)
    filters = cut(filters)
    size = filters.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    suspects = None
    if min_docs > 1 and size <= filter_bytes:
        suspects = docs.sparkSession.sparkContext.broadcast(
            joined(slices, filters.collect())
        )
    schema = pa.schema(
        [("digest", pa.binary()), ("docs", pa.int64()), ("doc_id", pa.int64()), ("line", pa.int64())]
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bytes, int] = {}
            first: dict[bytes, tuple[int, int]] = {}
            for doc, text in zip(column(batch, "doc_id").to_pylist(), text_bytes(batch)):
                lines = {}
                for number, line in enumerate(text.as_py().split(b"\n")):
                    lines.setdefault(line_key(line), number)
                found = [(line_digest(k), n) for k, n in lines.items() if _long_enough(k, min_chars)]
                if suspects is not None and found:
                    hit = maybe_in(suspects.value, _hashes([d for d, _ in found]))
                    found = [found[i] for i in np.flatnonzero(hit)]
                for digest, number in found:
                    counts[digest] = counts.get(digest, 0) + 1
                    if doc is not None:
                        first[digest] = min(first.get(digest, (doc, number)), (doc, number))
            where = [first.get(d, (None, None)) for d in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts), pa.binary()),
                    pa.array(list(counts.values()), pa.int64()),
                    pa.array([w[0] for w in where], pa.int64()),
                    pa.array([w[1] for w in where], pa.int64()),
                ],
                schema=schema,
            )
        give_back()

    place = F.struct("doc_id", "line")
    return (
        docs.select("doc_id", "text")
        .mapInArrow(emit, "digest binary, docs long, doc_id long, line long")
        .groupBy("digest")
        .agg(
            F.sum("docs").alias("docs"),
            F.min(F.when(F.col("doc_id").isNotNull(), place)).alias("first"),
        )
        .where(F.col("docs") >= min_docs)
    )


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    sent_keys: int = SENT_KEYS,
    filter_bytes: int = SENT_BYTES,
) -> DataFrame:
    """``docs`` with shared lines taken out of ``text``, and ``n_lines``, ``n_dropped``.

    Lines end at \\n. Two lines are the same when their keys are: the line without ASCII white space
    at its ends, A-Z lower-cased. A key of at least ``min_chars`` code points in at least
    ``min_docs`` rows of ``docs`` loses all its lines; with ``keep_first`` the first one, by doc_id
    and line number, stays. Null texts count as empty, which is one empty line, and stay null.
    Other columns pass through; input columns called n_lines or n_dropped are replaced.

    Up to ``sent_keys`` confirmed lines are sent to the tasks, which then rewrite each text where it
    is; beyond that the lines are joined with them and put together again.
    """
    docs = docs.drop("n_lines", "n_dropped")
    confirmed = cut(repeated_lines(docs, min_docs, min_chars, filter_bytes))
    if confirmed.count() <= sent_keys:
        return _rewritten(docs, confirmed, keep_first)
    return _rejoined(docs, confirmed, keep_first)


def _rewritten(docs: DataFrame, confirmed: DataFrame, keep_first: bool) -> DataFrame:
    first = {
        bytes(r["digest"]): tuple(r["first"]) if keep_first and r["first"] else None
        for r in confirmed.select("digest", "first").toLocalIterator()
    }
    sent = docs.sparkSession.sparkContext.broadcast(first)
    schema = (
        T.StructType(list(docs.schema.fields))
        .add("n_lines", T.LongType())
        .add("n_dropped", T.LongType())
    )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = sent.value
        for batch in batches:
            texts, total, dropped = [], [], []
            doc_ids = column(batch, "doc_id").to_pylist()
            for doc, text, known in zip(doc_ids, text_bytes(batch), column(batch, "text").is_valid()):
                lines = text.as_py().split(b"\n")
                digests = [line_digest(line_key(line)) for line in lines]
                kept = [
                    line
                    for number, (line, digest) in enumerate(zip(lines, digests))
                    if digest not in gone or gone[digest] == (doc, number)
                ]
                texts.append(b"\n".join(kept) if known.as_py() else None)
                total.append(len(lines))
                dropped.append(len(lines) - len(kept))
            at = batch.schema.get_field_index("text")
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            arrays += [pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]
            names = [*batch.schema.names, "n_lines", "n_dropped"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        give_back()

    return docs.mapInArrow(rewrite, schema)


def _rejoined(docs: DataFrame, confirmed: DataFrame, keep_first: bool) -> DataFrame:
    """One row per line, joined with the confirmed ones, and grouped by document again."""
    rows = docs.withColumn("_row", F.monotonically_increasing_id())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(column(batch, "_row"), text_bytes(batch)):
                lines = text.as_py().split(b"\n")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.as_py()] * len(lines), pa.int64()),
                        pa.array(range(len(lines)), pa.int64()),
                        pa.array(lines, pa.binary()).cast(pa.string()),
                        pa.array([line_digest(line_key(x)) for x in lines], pa.binary()),
                    ],
                    names=["_row", "_line", "_text", "digest"],
                )

    lines = rows.select("_row", "text").mapInArrow(
        split, "_row long, _line long, _text string, digest binary"
    )
    lines = lines.join(rows.select("_row", F.col("doc_id").alias("_doc")), "_row")
    gone = confirmed.select("digest", "first", F.lit(True).alias("gone"))
    is_first = (F.col("first.doc_id") == F.col("_doc")) & (F.col("first.line") == F.col("_line"))
    drop = F.coalesce("gone", F.lit(False)) & ~(F.lit(keep_first) & F.coalesce(is_first, F.lit(False)))
    kept = F.sort_array(F.collect_list(F.when(~F.col("drop"), F.struct("_line", "_text"))))
    texts = (
        lines.join(gone, "digest", "left")
        .withColumn("drop", drop)
        .groupBy("_row")
        .agg(
            F.array_join(F.transform(kept, lambda x: x["_text"]), "\n").alias("_kept"),
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if("drop").alias("n_dropped"),
        )
    )
    joined = rows.join(texts, "_row")
    return joined.select(
        *[
            F.when(joined["text"].isNotNull(), F.col("_kept")).alias("text") if c == "text" else joined[c]
            for c in docs.columns
        ],
        "n_lines",
        "n_dropped",
    )
