"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from labelbench.llm import queries, search
from odd_docs import odd_rows, words

ITEMS = [
    (1, "the same line a b c"),
    (2, "a a a zz A"),
    (3, None),
    (4, ""),
    (None, "exact copy of one text"),
    (5, "notaword anywhere 0x"),
    (1, "new1 new2 new3 ä"),
]


def _terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def _brute(docs, items, top):
    counts = [Counter(_terms(text)) for _, text in docs]
    sizes = [sum(c.values()) for c in counts]
    n_docs, length = sum(map(bool, sizes)), sum(sizes)
    df = Counter(t for c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    found = []
    for item, text in items:
        scored = []
        for (doc, _), own, n in zip(docs, counts, sizes):
            m = 100 - 25 + (25 * n * n_docs) // max(1, length)
            score = sum(
                weight[t] * ((1_000_000_000 * own[t]) // (1000 * own[t] + 12 * m)) for t in _terms(text) if own[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort()
        found += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(scored[:top])]
    return Counter(found)


def _docs():
    rng = random.Random(9)
    rows = [(r[0], r[1]) for r in odd_rows()]
    return rows + [(500 + i, " ".join(words(rng, rng.randint(1, 30), "abz"))) for i in range(150)]


@pytest.mark.parametrize(("shard_docs", "query_bytes", "top"), [(2048, 1 << 20, 20), (16, 30, 3)])
def test_ranks_and_scores_equal_brute_force(spark, monkeypatch, shard_docs, query_bytes, top):
    """In one shard a task and one pass, and in many of each."""
    monkeypatch.setattr(search, "SHARD_DOCS", shard_docs)
    docs = spark.createDataFrame(_docs(), "doc_id long, text string").repartition(3).cache()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = search.ranked_documents(docs, items, top=top, query_bytes=query_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == _brute(_docs(), ITEMS, top)


def test_the_registered_query(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(_docs(), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = queries.op13_ranked_search(spark, folder)
    assert dict(found.dtypes)["rank"] == "int"
    assert Counter(map(tuple, found.collect())) == _brute(_docs(), ITEMS, 20)


def test_nothing_to_rank(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.ranked_documents(no_docs, items).count() == 0
    assert search.ranked_documents(docs, items.limit(0)).count() == 0
    assert search.ranked_documents(docs, items.where("item_id IN (3, 4)")).count() == 0


def test_blocks_are_skipped_and_nothing_is_lost():
    """Documents of two kinds: most blocks of the common terms cannot reach the best."""
    rng = np.random.default_rng(5)
    terms, n = 60, 1500
    held = rng.random((terms, n)) < np.where(np.arange(n) % 2, 0.3, 0.05)[None, :]
    held[:3] |= rng.random((3, n)) < 0.8
    matrix = held * rng.integers(1, 1000, (terms, n)) * np.where(np.arange(terms) < 3, 1, 20)[:, None]
    texts = [" ".join(f"t{i}" for i in rng.choice(terms, 9)).encode() for _ in range(40)]
    queries_ = search.Queries([" ".join(f"t{i}" for i in range(terms)).encode(), *texts])
    best = [search.Best(5) for _ in queries_.terms]
    made = 0
    for part in np.array_split(np.arange(n), 3):
        shard = search.Shard(matrix[:, part], queries_.asked)
        made += search.search_shard(shard, queries_, best, part, np.ones(len(part), bool))
    for (which, repeats), found in zip(queries_.terms, best):
        scores = repeats @ matrix[which]
        order = np.lexsort((np.arange(n), -scores))[:5]
        assert found.id.tolist() == order.tolist() and found.score.tolist() == scores[order].tolist()
    assert made < 0.9 * n * len(best)


def test_summaries_are_maxima_of_their_blocks():
    rng = np.random.default_rng(6)
    matrix = rng.integers(0, 50, (8, 200)) * (rng.random((8, 200)) < 0.4)
    asked = {t: np.arange(8) for t in range(8)}
    shard = search.Shard(matrix, asked, groups=4)
    documents, first, summaries = shard.blocks(2)
    assert sorted(documents.tolist()) == np.flatnonzero(matrix[2]).tolist()
    for start, end, summary in zip(first, [*first[1:], len(documents)], summaries.T):
        assert summary.tolist() == matrix[:, documents[start:end]].max(axis=1).tolist()
