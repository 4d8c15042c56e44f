"""Decontamination against brute force, and the FM-index on its own."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from labelbench.llm import leaks, queries
from labelbench.llm.fm_index import FMIndex, WaveletMatrix, suffix_array
from odd_docs import odd_rows, words

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "The SAME line"),
    (3, ""),
    (4, None),
    (None, "exact, copy"),
    (5, "nowhere to be found in any of these texts at all today"),
    (2, "Éé x-y"),
    (6, "... !!"),
]


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))


def _hits(text, items, width):
    """(a flag for each word, names of the items that occur)."""
    own, names = _words(text), set()
    hit = [False] * len(own)
    for item, passage in items:
        found = _words(passage)
        size = min(width, len(found))
        windows = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if size and tuple(own[i : i + size]) in windows:
                names.add("" if item is None else str(item))
                hit[i : i + size] = [True] * size
    return hit, names


def _odd_texts():
    rows = [(r[0], r[1]) for r in odd_rows()]
    passage = ITEMS[0][1].upper()
    rows += [
        (200, f"before {passage}; {passage} after"),
        (201, "one two three four five six seven eight nine ten"),
        (202, "two three four five six seven eight nine ten"),
        (202, "Éé,x\ny-Éé x y"),
        (None, "exact copy"),
    ]
    return rows + rows[-4:]


@pytest.mark.parametrize("item_bytes", [16 << 20, 40])
def test_hits_and_items_equal_brute_force(spark, item_bytes):
    """With 40 bytes a block the items are searched in several passes whose spans are merged."""
    rows = _odd_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").cache()
    found = leaks.leaks(docs, benchmark, item_bytes=item_bytes).collect()
    wanted = Counter()
    for doc, text in rows:
        hit, names = _hits(text, ITEMS, 10)
        wanted[doc, text, len(hit), sum(hit), tuple(sorted(names))] += 1
    got = Counter(
        (r[0], r[1], r["words"], sum(s["end"] - s["word"] for s in r["spans"]), tuple(r["items"])) for r in found
    )
    assert got == wanted
    for r in found:
        hit, _ = _hits(r["text"], ITEMS, 10)
        flags = [False] * len(hit)
        for s in r["spans"]:
            flags[s["word"] : s["end"]] = [True] * (s["end"] - s["word"])
            inside = r["text"].encode()[s["byte"] : s["byte_end"]].decode()
            assert _words(inside) == _words(r["text"])[s["word"] : s["end"]]
        assert flags == hit


def test_removed_spans_leave_the_rest(spark):
    rows = _odd_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    for r in leaks.without_leaks(docs, benchmark).collect():
        if r["doc_id"] == 200:
            assert r["text"] == "before  after" and r["n_removed"] == 24
    kept = Counter((r[0], r[1]) for r in leaks.without_leaks(docs, benchmark).collect() if not r["n_removed"])
    assert kept == Counter((d, t) for d, t in rows if not any(_hits(t, ITEMS, 10)[0]))


def test_nothing_to_search(spark, odd, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.leaks(no_docs, none).count() == 0
    assert all(not r["spans"] and not r["items"] for r in leaks.leaks(odd, none).collect())


def test_the_registered_query(spark, tmp_path):
    folder = str(tmp_path)
    rows = _odd_texts()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    wanted = Counter()
    for doc, text in rows:
        hit, names = _hits(text, ITEMS, 10)
        digest = sha256(",".join(sorted(names)).encode()).hexdigest()
        wanted[doc, len(hit), sum(hit), len(names), digest, any(hit)] += 1
    found = queries.op11_decontamination(spark, folder)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(map(tuple, found.collect())) == wanted


def test_suffixes_are_sorted():
    rng = random.Random(2)
    for n in (0, 1, 2, 50, 400):
        for letters in (1, 2, 1000):
            text = [rng.randrange(letters) for _ in range(n)]
            assert suffix_array(np.array(text, np.int64)).tolist() == sorted(range(n), key=lambda i: text[i:])


def test_ranks_of_a_wavelet_matrix():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 37, 1000)
    matrix = WaveletMatrix(text, 6)
    at = rng.integers(0, 1001, 300)
    symbols = rng.integers(0, 37, 300)
    assert matrix.rank(symbols, at).tolist() == [int((text[:i] == s).sum()) for i, s in zip(at, symbols)]
    read, before = matrix.read(at[at < 1000])
    assert read.tolist() == text[at[at < 1000]].tolist()
    assert before.tolist() == [int((text[:i] == text[i]).sum()) for i in at[at < 1000]]


def test_phrases_are_counted_and_located_in_copies():
    rng = random.Random(4)
    texts = [words(rng, rng.randint(0, 60), "ab") for _ in range(12)]
    texts += texts[:6] * 3
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    names = {w: i * 7919 for i, w in enumerate(sorted({w for t in texts for w in t}))}
    hashes = np.array([names[w] for t in texts for w in t], np.uint64)
    index = FMIndex(owner, hashes, len(texts))
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    for size in (1, 2, 5):
        phrase = texts[0][3 : 3 + size]
        low, high = index.search(np.array([[names[w] for w in phrase]], np.uint64))
        found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        wanted = [s + i for s, t in zip(starts, texts) for i in range(len(t)) if t[i : i + size] == phrase]
        assert found == wanted
    absent = index.search(np.array([[1, 2]], np.uint64))
    assert absent[0][0] == absent[1][0]
