"""Ranked lexical search: posting lists in geometric blocks, skipped by exact summary bounds.

One scan keeps of every document its length and how often it holds the terms of the queries, and
counts for each term the documents that hold it. A second pass reads these in shards. There each
term's posting list falls into blocks of documents that are alike, and a block's summary is the
coordinatewise maximum of what its documents score for each term. A query goes through the lists of
its heaviest terms first and skips a block when its summary shows that no document in it can reach
the worst of the best found so far. Only the best of each task are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelbench.llm.batches import column, runs, text_bytes
from labelbench.llm.words import word_spans
from labelbench.shared import cut

RUN_BYTES = 2 << 20
QUERY_BYTES = 1 << 20  # of query texts that are answered in one pass
SHARD_BYTES = 32 << 20  # of one shard's scores, documents by terms
SHARD_DOCS = 2048
GROUPS = 16  # of documents that are alike, in a shard
LEAST_LIST = 12  # shorter posting lists have no blocks
SALTS = 64

FORWARD = "doc_id long, n long, terms binary, times binary, term long, holders long"


class Queries:
    """The distinct terms of some queries, by hash, and each query's terms with their numbers."""

    def __init__(self, texts: list[bytes]):
        row, hashes, _, _ = word_spans(texts)
        self.hashes, term = np.unique(hashes, return_inverse=True)
        self.terms: list[tuple[np.ndarray, np.ndarray]] = []
        for query in range(len(texts)):
            self.terms.append(np.unique(term[row == query], return_counts=True))
        asked: dict[int, set] = {}
        for terms, _ in self.terms:
            for one in terms.tolist():
                asked.setdefault(one, set()).update(terms.tolist())
        # For each term those that its queries ask for too, and where each query's are among them.
        self.asked = {one: np.array(sorted(others)) for one, others in asked.items()}


def term_counts(texts: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(terms in each text, text of each posting, its term, its times), by text and term.

    Postings are only those of the terms in ``hashes``, which are sorted.
    """
    row, words, _, _ = word_spans(texts)
    n = np.bincount(row, minlength=len(texts))
    if not len(hashes):
        none = np.zeros(0, np.int64)
        return n, none, none, none
    term = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
    known = hashes[term] == words
    pairs, times = np.unique(row[known] * len(hashes) + term[known], return_counts=True)
    return n, pairs // len(hashes), pairs % len(hashes), times


def _kept(sent: dict, name: str, make):
    """Made once per worker process; it stays with the broadcast value."""
    if name not in sent:
        sent[name] = make()
    return sent[name]


def forward_index(docs: DataFrame, texts: list[bytes]) -> DataFrame:
    """Rows of two kinds: ``doc_id``, ``n``, ``terms``, ``times`` of every document, and per task the
    ``holders`` of each ``term`` it met. Terms are numbers of those in the query ``texts``."""
    sent = docs.sparkSession.sparkContext.broadcast({"texts": texts})
    names = ["doc_id", "n", "terms", "times", "term", "holders"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _kept(sent.value, "queries", lambda: Queries(sent.value["texts"])).hashes
        holders = np.zeros(len(hashes), np.int64)
        for batch in batches:
            for part in runs(batch, RUN_BYTES):
                n, row, term, times = term_counts(text_bytes(part).to_pylist(), hashes)
                holders += np.bincount(term, minlength=len(hashes))
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                packed = [
                    [values[a:b].astype("<i4").tobytes() for a, b in zip(ends, ends[1:])]
                    for values in (term, times)
                ]
                nothing = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "doc_id"),
                        pa.array(n, pa.int64()),
                        *[pa.array(p, pa.binary()) for p in packed],
                        nothing,
                        nothing,
                    ],
                    schema=schema,
                )
        met = np.flatnonzero(holders)
        empty = [pa.nulls(len(met), t) for t in types[:4]]
        yield pa.RecordBatch.from_arrays(
            [*empty, pa.array(met, pa.int64()), pa.array(holders[met], pa.int64())], schema=schema
        )

    return docs.select("doc_id", "text").mapInArrow(run, FORWARD)


def term_weights(holders: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    return np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holders], np.int64
    )


def scores(weights: np.ndarray, times: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What each posting adds to a score, ``weights``, ``times`` and the document's ``n`` beside
    each other. All in 64-bit integers, as divisions round down."""
    m = 75 + 25 * n * documents // max(1, length)
    return weights * (1_000_000_000 * times // (1000 * times + 12 * m))


def groups_of(matrix: np.ndarray, groups: int) -> np.ndarray:
    """The documents' groups: each goes to the most alike, by cosine, of a few spread over the shard."""
    vectors = np.sqrt(matrix.T.astype(np.float32))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    pivots = vectors[np.linspace(0, len(vectors) - 1, min(groups, len(vectors))).astype(int)]
    return (vectors @ pivots.T).argmax(axis=1)


class Shard:
    """Posting lists of some documents in blocks. ``matrix`` has what each term (row) adds to the
    score of each document (column)."""

    def __init__(self, matrix: np.ndarray, asked: dict[int, np.ndarray], groups: int = GROUPS):
        self.matrix, self.asked = matrix, asked
        self.most = matrix.max(axis=1, initial=0)
        group = groups_of(matrix, groups)
        self.order = np.argsort(group, kind="stable")
        self.group = group[self.order]
        self.lists: dict[int, tuple] = {}

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
        """(documents of the term's list, group by group, first of each block, summaries). A summary
        has a row for each term that queries ask for beside this one. Short lists have no blocks."""
        if term not in self.lists:
            held = self.matrix[term, self.order] > 0
            documents, group = self.order[held], self.group[held]
            first = summaries = None
            if len(documents) >= LEAST_LIST:
                first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                adds = self.matrix[np.ix_(self.asked[term], documents)]
                summaries = np.maximum.reduceat(adds, first, axis=1)
            self.lists[term] = documents, first, summaries
        return self.lists[term]

    def candidates(self, term: int, terms: np.ndarray, repeats: np.ndarray, floor: int) -> np.ndarray:
        """The documents of the term's list whose block may hold a score of ``floor`` or more."""
        documents, first, summaries = self.blocks(term)
        if first is None:
            return documents
        bound = repeats @ summaries[np.searchsorted(self.asked[term], terms)]
        return documents[np.repeat(bound >= floor, np.diff(np.append(first, len(documents))))]


class Best:
    """The ``size`` best of one query: highest scores first, then smallest doc_ids, null last."""

    def __init__(self, size: int):
        self.size = size
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known = np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """No document below this score gets in."""
        return int(self.score[-1]) if len(self.score) == self.size else 1

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = score >= self.floor
        score = np.concatenate([self.score, score[good]])
        ids, known = np.concatenate([self.id, ids[good]]), np.concatenate([self.known, known[good]])
        order = np.lexsort((ids, ~known, -score))[: self.size]
        self.score, self.id, self.known = score[order], ids[order], known[order]


def search_shard(shard: Shard, queries: Queries, best: list[Best], ids: np.ndarray, known: np.ndarray) -> int:
    """Improves ``best``, one of each query, by the documents of the shard; returns how many
    (query, document) scores were made."""
    made = 0
    for (terms, repeats), found in zip(queries.terms, best):
        most = shard.most[terms] * repeats
        by_weight = np.argsort(most, kind="stable")
        reach = np.cumsum(most[by_weight])  # of documents with none of the heavier terms
        seen = np.zeros(shard.matrix.shape[1], bool)
        for place in range(len(terms) - 1, -1, -1):
            if reach[place] < found.floor:
                break
            term = int(terms[by_weight[place]])
            if not shard.most[term]:
                continue
            documents = shard.candidates(term, terms, repeats, found.floor)
            documents = documents[~seen[documents]]
            if len(documents):
                seen[documents] = True
                made += len(documents)
                score = repeats @ shard.matrix[np.ix_(terms, documents)]
                found.add(score, ids[documents], known[documents])
    return made


def _shards(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[tuple]:
    """(doc_ids, known ones, n, owner, term, times) for so many documents at a time as fit."""
    limit = max(1, min(SHARD_DOCS, SHARD_BYTES // (8 * max(1, terms))))
    for batch in batches:
        for at in range(0, batch.num_rows, limit):
            part = batch.slice(at, limit)
            ids = column(part, "doc_id")
            sizes = np.array([len(t) // 4 for t in column(part, "terms").to_pylist()], np.int64)
            term, times = (
                np.frombuffer(b"".join(column(part, c).to_pylist()), "<i4").astype(np.int64)
                for c in ("terms", "times")
            )
            yield (
                ids.fill_null(0).to_numpy(zero_copy_only=False),
                ids.is_valid().to_numpy(zero_copy_only=False),
                column(part, "n").to_numpy(zero_copy_only=False),
                np.repeat(np.arange(part.num_rows), sizes),
                term,
                times,
            )


def _answers(docs: DataFrame, items: list, top: int) -> DataFrame:
    """``item_id``, ``doc_id``, ``score``, ``rank`` of the best documents for some items."""
    texts = [(row["text"] or "").encode() for row in items]
    index = cut(forward_index(docs, texts))
    rows = index.where("term IS NULL").select("doc_id", "n", "terms", "times")
    whole = rows.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    documents, length = whole[0] or 0, whole[1] or 0
    holders = index.where("term IS NOT NULL").groupBy("term").agg(F.sum("holders").alias("n")).collect()
    queries = Queries(texts)
    df = np.zeros(len(queries.hashes), np.int64)
    for row in holders:
        df[row["term"]] = row["n"]
    sent = docs.sparkSession.sparkContext.broadcast(
        {"texts": texts, "weights": term_weights(df, documents), "whole": (documents, length)}
    )
    schema = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _kept(sent.value, "queries", lambda: Queries(sent.value["texts"]))
        weights, (documents, length) = sent.value["weights"], sent.value["whole"]
        best = [Best(top) for _ in queries.terms]
        for ids, known, n, owner, term, times in _shards(batches, len(weights)):
            matrix = np.zeros((len(weights), len(ids)), np.int64)
            matrix[term, owner] = scores(weights[term], times, n[owner], documents, length)
            search_shard(Shard(matrix, queries.asked), queries, best, ids, known)
        counts = [len(b.score) for b in best]
        found = [np.concatenate([getattr(b, c) for b in best]) for c in ("id", "known", "score")]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(best)), counts), pa.int64()),
                pa.array(found[0], pa.int64(), mask=~found[1].astype(bool)),
                pa.array(found[2], pa.int64()),
            ],
            schema=schema,
        )

    if not len(queries.hashes):
        rows = rows.limit(0)
    found = rows.mapInArrow(run, "query long, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # First inside parts of a query's rows, so that no task gets all that the tasks found for it.
    some = Window.partitionBy("query", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))).orderBy(*order)
    every = Window.partitionBy("query").orderBy(*order)
    ranked = (
        found.withColumn("rank", F.row_number().over(some))
        .where(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(every))
        .where(F.col("rank") <= top)
    )
    names = docs.sparkSession.createDataFrame(
        [(number, row["item_id"]) for number, row in enumerate(items)], "query long, item_id long"
    )
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def ranked_documents(
    docs: DataFrame, items: DataFrame, top: int = 20, query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` best documents for every row of
    ``items`` (``item_id``, ``text``), the best first, equal scores by doc_id, null last.

    Terms are runs of digits, ASCII letters (A-Z as a-z) and characters beyond ASCII. With N the
    documents that hold a term, L all their terms, n one document's, df the documents that hold the
    term and tf its occurrences in the document, a term weighs w = floor(1000 ln((2N+2) / (2df+1))) and
    adds w * (1000000000 tf div (1000 tf + 12 m)) with m = 75 + 25 n N div L, for each time the item
    holds it. Documents without a common term of any weight are not listed. Null and empty texts hold
    no terms. Rows are documents and items even where they repeat an id. Terms are told apart by hashes
    of 64 bits.

    Items beyond ``query_bytes`` of text are answered in blocks, one pass over the documents each.
    """
    items = cut(items.select("item_id", "text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // query_bytes
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        answers = _answers(docs, own.collect(), top)
        found = answers if found is None else found.union(answers)
    return found
