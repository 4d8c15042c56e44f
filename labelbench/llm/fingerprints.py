"""Homomorphic multiset fingerprints of documents.

A document is the multiset of its paragraphs. A paragraph's vector has two parts. ``EXACT`` lanes
hold its hash, summed modulo 2**64; they tell multisets apart. ``WIDE`` lanes hold its byte
eight-grams, each +1 or -1 in the lane that its hash names, summed modulo 2**32; their inner
products estimate how much two documents share. Vectors of paragraphs add up, so order does not
matter, and a paragraph is inserted or deleted by adding or subtracting its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelbench.llm.batches import column

EXACT = 8
WIDE = 256
GRAM = 8
CHUNK = 1 << 20  # bytes of a paragraph that are hashed at once
MOST_PARTS = 32_768


def _wide(data: bytes) -> np.ndarray:
    """Signed counts of the eight-grams that do not cross a line feed. Shorter pieces are padded."""
    lanes = np.zeros(WIDE, np.int64)
    for piece in (data[i : i + CHUNK + GRAM - 1] for i in range(0, max(1, len(data) - GRAM + 1), CHUNK)):
        raw = np.frombuffer(piece, np.uint8)
        grams = np.lib.stride_tricks.sliding_window_view(raw, GRAM)
        numbers = np.ascontiguousarray(grams).view(np.uint64).ravel()
        feeds = np.concatenate([[0], np.cumsum(raw == 10)])
        whole = feeds[GRAM:] == feeds[: len(numbers)]
        _count(lanes, numbers[whole])
    return lanes


def _count(lanes: np.ndarray, numbers: np.ndarray) -> None:
    mixed = (numbers ^ (numbers >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    lane = (mixed >> np.uint64(56)).astype(np.int64)
    sign = (mixed >> np.uint64(40) & np.uint64(1)).astype(np.int64)
    both = np.bincount(lane * 2 + sign, minlength=2 * WIDE)
    lanes += both[1::2] - both[::2]


def vector(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(exact lanes, wide lanes) of the paragraphs of ``data``, which end at \\n."""
    exact, short = np.zeros(EXACT, np.uint64), []
    for paragraph in data.split(b"\n"):
        exact += np.frombuffer(blake2b(paragraph, digest_size=8 * EXACT).digest(), np.uint64)
        if 0 < len(paragraph) < GRAM:
            short.append(paragraph.ljust(GRAM, b"\0"))
    wide = _wide(data) if len(data) >= GRAM else np.zeros(WIDE, np.int64)
    if short:
        _count(wide, np.frombuffer(b"".join(short), np.uint64))
    return exact, wide


def plus(a: tuple, b: tuple) -> tuple:
    """Insert the paragraphs of ``b``."""
    return a[0] + b[0], a[1] + b[1]


def minus(a: tuple, b: tuple) -> tuple:
    """Delete the paragraphs of ``b``."""
    return a[0] - b[0], a[1] - b[1]


def printed(v: tuple) -> str:
    return v[0].astype("<u8").tobytes().hex() + v[1].astype("<u4").tobytes().hex()


def likeness(a: tuple, b: tuple) -> float:
    """Estimated shared part of the larger multiset of eight-grams, 0 to 1; 1 for equal ones."""
    x, y = (v[1].astype(np.uint32).astype(np.int32).astype(np.float64) for v in (a, b))
    if (a[0] == b[0]).all() and (x == y).all():
        return 1.0
    most = max(x @ x, y @ y)
    return float(min(1.0, max(0.0, (x @ y) / most))) if most else 0.0


def edited_bytes(text: str, following: str) -> tuple[bytes, int]:
    """(UTF-8 of the text with its last third replaced by the start of the next; the byte from which
    its paragraphs differ)."""
    cut_off = len(text) // 3
    kept = text[: len(text) - cut_off].encode()
    return kept + following[:cut_off].encode(), kept.rfind(b"\n") + 1


def _with_parts(docs: DataFrame, rows_per_part: int) -> tuple[DataFrame, int]:
    """Texts in parts of descending doc_id, with the first row of the next part at each one's end.

    Bounds are quantiles of doc_id. They and the first doc_id of each part, one number per part of at
    most ``MOST_PARTS``, are sent to the tasks; beyond that parts grow, and Spark sorts them on disk.
    """
    rows = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast
    parts = max(1, min(MOST_PARTS, rows.count() // rows_per_part))
    found: list = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        found = rows.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] or []
    bounds = sent(-np.array(sorted(set(found), reverse=True), np.int64))
    last = len(bounds.value)

    def number(ids: pd.Series) -> np.ndarray:
        """Part i has doc_ids up to bound i - 1 and above bound i; nulls come last."""
        known = ids.fillna(0).to_numpy(np.int64)
        return np.where(ids.isna(), last, np.searchsorted(bounds.value, -known, side="right"))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(number(ids))

    tops = (
        rows.select("doc_id", part_of("doc_id").alias("part"))
        .groupBy("part")
        .agg(F.max("doc_id").alias("top"))
        .orderBy("part")
        .collect()
    )
    top, before = np.zeros(last + 1, np.int64), np.zeros(last + 1, np.int64)
    for i, row in enumerate(tops):
        top[row["part"]] = -1 if row["top"] is None else row["top"]
        before[row["part"]] = tops[i - 1]["part"]  # the very first row ends the last part
    all_null = bool(tops) and tops[-1]["top"] is None
    marks = sent((top, before, all_null))

    @F.pandas_udf("part int, head boolean, before int")
    def placed_in(ids: pd.Series) -> pd.DataFrame:
        top, before, all_null = marks.value
        part = number(ids)
        head = np.where(ids.isna(), all_null & (part == last), ids.fillna(0).to_numpy(np.int64) == top[part])
        return pd.DataFrame({"part": part, "head": head.astype(bool), "before": before[part]})

    placed = rows.withColumn("place", placed_in("doc_id"))
    first = placed.where("place.head").groupBy("place.before", "doc_id").agg(F.max("text").alias("text"))
    ends = first.select("doc_id", "text", F.col("before").alias("part"), F.lit(True).alias("end"))
    own = placed.select("doc_id", "text", "place.part", F.lit(False).alias("end"))
    return own.unionByName(ends), last + 1


def fingerprints(docs: DataFrame, rows_per_part: int = 4000) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and that of its edited text: ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``.

    The edited text is the text without its last floor(n_chars / 3) code points, followed by as many
    of the next document, by descending doc_id; the first follows the last. Null texts count as
    empty; null doc_ids come last; rows with one doc_id follow each other by descending text. A lone
    document is followed by itself. No rows give no rows.

    Texts are shuffled once, into parts of bounded size; a part also gets the row that follows it.
    """
    rows, parts = _with_parts(docs, rows_per_part)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64())]
        + [(n, pa.string()) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def finished(row: tuple, following: tuple) -> tuple:
        doc, text, own = row
        data, start = edited_bytes(text, following[1])
        # Only paragraphs from the cut on change: delete the old ones, insert the new ones.
        changed = minus(own, vector(text.encode()[start:]))
        edited = plus(changed, vector(data[start:]))
        return (
            doc,
            len(text),
            sha256(data).hexdigest(),
            printed(own),
            printed(edited),
            likeness(own, edited),
            likeness(own, following[2]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, part = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                out = []
                columns = (column(some, n).to_pylist() for n in ("part", "end", "doc_id", "text"))
                for at, end, doc, text in zip(*columns):
                    text = text or ""
                    row = (doc, text, vector(text.encode()))
                    if waiting is not None and at == part:
                        out.append(finished(waiting, row))
                    waiting, part = (None if end else row), at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 7, schema)],
                    schema=schema,
                )

    return (
        rows.repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "end", F.desc_nulls_last("doc_id"), F.desc_nulls_last("text"))
        .mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _COLUMNS))
    )


_COLUMNS = [
    ("doc_id", "long"),
    ("n_chars", "long"),
    ("edited_sha256", "string"),
    ("fingerprint", "string"),
    ("edited_fingerprint", "string"),
    ("near_edited", "double"),
    ("near_next", "double"),
]
