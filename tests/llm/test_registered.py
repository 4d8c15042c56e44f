"""The registered forms of operators that SQL cannot express, against second versions, on small tables."""

import os
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from labelbench.llm import bpe, fingerprints, queries
from odd_docs import odd_rows, split_words
from test_jaccard import _roots, _shingles

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    return [*map(tuple, given), *odd_rows()]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_mixing(spark, rows, folder):
    found = queries.op1_mixing(spark, folder).collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((r[0], split_words(r[1])) for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += split_words(r[1])
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    level, taken = sum(sizes.values()), 0.0
    # The level of water that fills all sources, each up to three times its size.
    low, high = 0.0, float(level)
    for _ in range(200):
        middle = (low + high) / 2
        taken = sum(min(3 * n, weights[s] * middle) for s, n in sizes.items())
        low, high = (middle, high) if taken < level else (low, middle)
    targets = Counter(round(min(3.0 * n, weights[s] * high), 6) for s, n in sizes.items())
    assert Counter({t: 1 for t in targets}) == Counter({round(t, 6): 1 for t in {r["target"] for r in found}})
    assert {r["source_size"] for r in found} == set(sizes.values())
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in found)
    own = Counter()
    for r in found:
        own[r["target"]] += r["taken"]
    longest = max(split_words(r[1]) for r in rows)
    assert all(abs(own[t] - t) <= longest * list(targets.values()).count(1) for t in own)


def test_sharding(spark, rows, folder):
    found = queries.op2_sharding(spark, folder).collect()
    wanted = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == wanted
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}
    slots, of_text, load = defaultdict(list), defaultdict(set), Counter()
    for r in found:
        slots[r["shard"]].append(r["slot"])
        of_text[r["text_crc32"], r["size"]].add(r["shard"])
        load[r["shard"]] += r["size"]
    assert set(slots) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(shards) == 1 for shards in of_text.values())
    groups = Counter()
    for r in found:
        groups[r["text_crc32"], r["size"]] += r["size"]
    # No differencing can part a group of equal texts.
    assert max(load.values()) - min(load.values()) <= max(groups.values())


def test_fingerprints(spark, rows, folder):
    found = queries.op5_fingerprints(spark, folder).collect()
    texts = sorted(
        ((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True
    )
    wanted = Counter()
    for i, (doc, text) in enumerate(texts):
        k = len(text) // 3
        edited = text[: len(text) - k] + texts[(i + 1) % len(texts)][1][:k]
        wanted[doc, len(text), sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == wanted
    of_text = defaultdict(set)
    prints = defaultdict(set)
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[r["doc_id"], r["n_chars"]].add(r["fingerprint"])
    for doc, text in texts:
        if doc is not None and len(prints[doc, len(text)]) == 1:
            of_text[text] |= prints[doc, len(text)]
    assert all(len(p) == 1 for p in of_text.values())
    assert len(set().union(*of_text.values())) == len(of_text)


def _grams(paragraph):
    """A paragraph's runs of eight bytes, or all of a shorter one."""
    return Counter(paragraph[i : i + 8] for i in range(max(1, len(paragraph) - 7)))


def test_likeness_is_near_the_shared_part():
    """Against the multiset of eight-grams counted by hand."""
    rng = np.random.default_rng(3)
    for share in (0.0, 0.3, 0.7, 1.0):
        a = [bytes(rng.integers(97, 123, 60).tolist()) for _ in range(60)]
        b = a[: int(60 * share)] + [bytes(rng.integers(97, 123, 60).tolist()) for _ in range(60 - int(60 * share))]
        x, y = (sum((_grams(p) for p in ps), Counter()) for ps in (a, b))
        shared = sum((x & y).values()) / max(sum(x.values()), sum(y.values()))
        made = fingerprints.likeness(fingerprints.vector(b"\n".join(a)), fingerprints.vector(b"\n".join(b)))
        assert abs(made - shared) < 0.15


def test_language(spark, rows, folder):
    found = queries.op7_language_id(spark, folder).collect()
    assert len(found) == len(rows)
    for r in found:
        held_out = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == held_out and 0 <= r["score"] <= 1
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r)
    single = [r for r in found if len(texts[r["doc_id"]]) == 1]
    for r in single:
        text = texts[r["doc_id"]][0][1]
        assert (r["lang_pred"] == "und") == (not any(map(str.isalpha, text or "")))
    given = [r for r in single if r["held_out"] and texts[r["doc_id"]][0][4] not in (9, None)]
    right = [r["lang_pred"] == texts[r["doc_id"]][0][2] for r in given]
    assert sum(right) >= 0.9 * len(right) and len(right) > 20


def test_ngram_join(spark, rows, folder):
    sets, roots = _roots(rows)
    least = {}
    for root, row, s in zip(roots, rows, sets):
        if s and row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    wanted = Counter(
        (r[0], len(s), least.get(root) if s else r[0]) for root, r, s in zip(roots, rows, sets)
    )
    assert [len(_shingles(r[1])) for r in rows] == [len(s) for s in sets]
    assert Counter(map(tuple, queries.op9_ngram_jaccard(spark, folder).collect())) == wanted


def test_encoding(spark, rows, folder):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    wanted = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        wanted[r[0], len(ids), sha256(packed).hexdigest(), sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, queries.op10_bpe(spark, folder).collect())) == wanted


def test_a_second_task_finds_the_encoder(spark, rows, folder):
    """One worker process parses the vocabulary once for all its tasks."""
    sent = spark.sparkContext.broadcast({"spec": Path(public_tokenizers.path("byte_bpe_50k.json")).read_text("utf-8")})

    def run(batches):
        for batch in batches:
            known = "encoder" in sent.value
            bpe.held_encoder(sent.value)
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid() * 2 + known], pa.int64())], names=["id"])

    found = [r["id"] for r in spark.range(0, 64, 1, 64).mapInArrow(run, "id long").collect()]
    made = Counter(i // 2 for i in found if i % 2 == 0)
    assert len(found) == 64 and set(made.values()) == {1}
