"""Taking benchmark passages out of training text, found by an FM-index of each shard.

Every shard, a run of texts of bounded size, is indexed over its words. The windows of the benchmark
are searched backwards through the ranks of its wavelet matrix, their occurrences are located from
kept positions, and the words they cover are merged into spans for removal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelbench.llm.batches import column, runs, text_bytes
from labelbench.llm.fm_index import FMIndex
from labelbench.llm.words import word_spans
from labelbench.shared import cut

WIDTH = 10
SHARD_BYTES = 4 << 20
ROWS_AT_ONCE = 1 << 19
ITEM_BYTES = 16 << 20  # of benchmark texts that are sent to the tasks at once


class Windows:
    """The distinct windows of benchmark items: runs of ``width`` words, or a whole shorter item."""

    def __init__(self, texts: list[bytes], width: int):
        row, hashes, _, _ = word_spans(texts)
        counts = np.bincount(row, minlength=len(texts))
        starts = np.cumsum(counts) - counts
        self.lengths: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for length in np.unique(np.minimum(counts[counts > 0], width)).tolist():
            items = np.flatnonzero(np.minimum(counts, width) == length)
            owner = np.repeat(items, counts[items] - length + 1)
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            phrases = hashes[(starts[owner] + place)[:, None] + np.arange(length)]
            phrases, which = np.unique(phrases, axis=0, return_inverse=True)
            pairs = np.unique(np.column_stack([which.ravel(), owner]), axis=0)
            first = np.searchsorted(pairs[:, 0], np.arange(len(phrases) + 1))
            self.lengths.append((phrases, first, pairs[:, 1]))  # the items of each phrase


def _occurrences(index: FMIndex, windows: Windows) -> Iterator[tuple[np.ndarray, int, np.ndarray, tuple]]:
    """(positions, length, phrase of each, its items) for the occurrences of all windows."""
    for phrases, first, items in windows.lengths:
        low, high = index.search(phrases)
        ends = np.cumsum(high - low)
        for at in range(0, int(ends[-1]), ROWS_AT_ONCE):
            number = np.arange(at, min(at + ROWS_AT_ONCE, int(ends[-1])))
            phrase = np.searchsorted(ends, number, side="right")
            rows = high[phrase] - (ends[phrase] - number)
            yield index.locate(rows), phrases.shape[1], phrase, (first, items)


def _flat(first: np.ndarray, values: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``which``, value) for the values of each list named in ``which``."""
    sizes = first[which + 1] - first[which]
    owner = np.repeat(np.arange(len(which)), sizes)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, values[first[which][owner] + inner]


def leaks_of_shard(texts: list[bytes], windows: Windows) -> list[tuple[int, list, list]]:
    """(words, spans, items) of each text. A span is (first word, word after it, first byte, byte
    after it); items are their numbers."""
    owner, hashes, first, after = word_spans(texts)
    counts = np.bincount(owner, minlength=len(texts))
    index = FMIndex(owner, hashes, len(texts))
    cover = np.zeros(len(hashes) + len(texts) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for positions, length, phrase, (begin, items) in _occurrences(index, windows):
        np.add.at(cover, positions, 1)
        np.add.at(cover, positions + length, -1)
        document = index.document(positions)
        seen = np.unique(document * (len(begin) - 1) + phrase)
        which, item = _flat(begin, items, seen % (len(begin) - 1))
        pairs.append(np.unique(np.column_stack([(seen // (len(begin) - 1))[which], item]), axis=0))
    covered = np.append(False, np.cumsum(cover) > 0)  # never an end of a text
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    spans: list[list] = [[] for _ in texts]
    for start, end in edges.reshape(-1, 2).tolist():
        row = int(index.document(np.array(start)))
        word = start - int(index.text_start[row])
        at = start - row  # among the words of the shard
        last = at + end - start - 1
        spans[row].append((word, word + end - start, int(first[at]), int(after[last])))
    named: list[list] = [[] for _ in texts]
    for row, item in np.unique(np.concatenate(pairs), axis=0).tolist():
        named[row].append(item)
    return list(zip(counts.tolist(), spans, named))


def _windows(sent: dict) -> Windows:
    """Made once per worker process; it stays with the broadcast value."""
    if "windows" not in sent:
        sent["windows"] = Windows(sent["texts"], sent["width"])
    return sent["windows"]


SPANS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType()) for c in ("word", "end", "byte", "byte_end")])
)


def _found(docs: DataFrame, items: list, width: int) -> DataFrame:
    """``docs`` with ``_words``, ``_spans`` and ``_items``, in place."""
    texts = [(row["text"] or "").encode() for row in items]
    names = [None if row["item_id"] is None else str(row["item_id"]) for row in items]
    sent = docs.sparkSession.sparkContext.broadcast({"texts": texts, "width": width})
    schema = T.StructType(list(docs.schema.fields))
    schema = schema.add("_words", "long").add("_spans", SPANS).add("_items", T.ArrayType(T.StringType()))
    span_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("word", "end", "byte", "byte_end")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(sent.value)
        for batch in batches:
            for part in runs(batch, SHARD_BYTES):
                found = leaks_of_shard(text_bytes(part).to_pylist(), windows)
                spans = [[dict(zip(("word", "end", "byte", "byte_end"), s)) for s in f[1]] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([f[0] for f in found], pa.int64()),
                        pa.array(spans, span_type),
                        pa.array([sorted({names[i] or "" for i in f[2]}) for f in found], pa.list_(pa.string())),
                    ],
                    names=[*part.schema.names, "_words", "_spans", "_items"],
                )

    return docs.mapInArrow(run, schema)


def _merged(spans):
    """Spans in order of their words, those that overlap or touch as one."""

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["word"].alias("word"),
            F.greatest(last["end"], span["end"]).alias("end"),
            last["byte"].alias("byte"),
            F.greatest(last["byte_end"], span["byte_end"]).alias("byte_end"),
        )
        meets = (F.size(done) > 0) & (last["end"] >= span["word"])
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def _blocks(benchmark: DataFrame, item_bytes: int) -> Iterator[list]:
    """The items in blocks of about ``item_bytes`` of text, each collected on its own."""
    items = cut(benchmark.select("item_id", "text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // item_bytes
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield own.collect() if parts > 1 else items.collect()


def leaks(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, item_bytes: int = ITEM_BYTES
) -> DataFrame:
    """``doc_id``, ``text``, ``words``, ``spans``, ``items`` for every row of ``docs``.

    Words are runs of digits, ASCII letters (A-Z as a-z) and characters beyond ASCII. A window is
    ``width`` consecutive words of an item, or all words of a shorter one that has any. ``spans``
    are the words inside occurrences of windows, merged, with the bytes they stand at; ``items`` are
    the item_ids, as strings in order, with a window that occurs. Null and empty texts have no words.
    Items without an id are one named by the empty string; several rows of an id are one item. Words
    are compared by hashes of 64 bits. No rows give no rows.

    Items beyond ``item_bytes`` of text are searched in blocks, one pass over the texts each, and
    the spans of equal rows are merged.
    """
    texts = docs.select("doc_id", "text")
    blocks = [_found(texts, items, width) for items in _blocks(benchmark, item_bytes)]
    if len(blocks) == 1:
        return blocks[0].select(
            "doc_id", "text", F.col("_words").alias("words"), F.col("_spans").alias("spans"), F.col("_items").alias("items")
        )
    keyed = [
        block.select("doc_id", F.md5("text").alias("_md5"), "_words", "_spans", "_items") for block in blocks
    ]
    every = keyed[0]
    for block in keyed[1:]:
        every = every.union(block)
    found = (
        cut(every)
        .groupBy(F.col("doc_id").alias("_id"), "_md5")
        .agg(
            F.max("_words").alias("words"),
            F.flatten(F.collect_set("_spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"),
        )
        .withColumn("spans", _merged(F.col("spans")))
    )
    own = texts.withColumn("_own", F.md5("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_own").eqNullSafe(F.col("_md5"))
    return own.join(found, same).select("doc_id", "text", "words", "spans", "items")


def hit_words(spans: str = "spans"):
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["word"])


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``text`` without the spans that :func:`leaks` finds, and ``n_removed`` words."""
    found = leaks(docs, benchmark, **options).withColumn("n_removed", hit_words())
    schema = "doc_id long, text string, n_removed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(text_bytes(batch).to_pylist(), column(batch, "spans").to_pylist()):
                at, kept = 0, []
                for span in spans:
                    kept.append(text[at : span["byte"]])
                    at = span["byte_end"]
                texts.append(b"".join([*kept, text[at:]]).decode())
            known = column(batch, "text").is_valid().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array([t if k else None for t, k in zip(texts, known)], pa.string()),
                    column(batch, "n_removed"),
                ],
                names=["doc_id", "text", "n_removed"],
            )

    return found.select("doc_id", "text", "spans", "n_removed").mapInArrow(run, schema)
