import random
from collections import Counter, defaultdict
from math import isqrt

import pytest
from pyspark.sql import functions as F

from odd_docs import odd_rows, split_words, words
from labelbench.llm import mixing


def _level(sizes, weights, repeats):
    """Targets by resharing what is above the caps again and again."""
    total, open_ = sum(sizes.values()), set(sizes)
    targets = {}
    while True:
        left = total - sum(targets.values())
        share = left / sum(weights[s] for s in open_) if open_ else 0
        full = {s for s in open_ if weights[s] * share > repeats * sizes[s]}
        if not full:
            return targets | {s: weights[s] * share for s in open_}
        targets |= {s: repeats * sizes[s] for s in full}
        open_ -= full


def test_targets_taken_and_reruns(odd):
    rows = mixing.taken_words(odd).collect()
    assert sorted(rows, key=str) == sorted(mixing.taken_words(odd.repartition(3)).collect(), key=str)
    wanted = [(r[0], r[3], split_words(r[1])) for r in odd_rows()]
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d, n) for d, _, n in wanted)
    sizes = defaultdict(int)
    for _, source, n in wanted:
        sizes[source] += n
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    targets = _level(sizes, weights, 3)
    found = {(r["source"], r["source_size"], r["target"]) for r in mixing.fair_queue(odd).collect()}
    assert {s: (n, t) for s, n, t in found} == {
        s: (sizes[s], pytest.approx(targets[s])) for s in sizes
    }
    assert all(r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"] for r in rows)
    taken = defaultdict(int)
    for r in mixing.fair_queue(odd).collect():
        taken[r["source"]] += r["size"] * r["copies"]
    longest = {s: max(n for _, t, n in wanted if t == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in sizes)
    assert sum(taken.values()) <= sum(sizes.values())


def _by_hand(docs, cycle=(1, 2, 3), repeats=3):
    """Copies of each row: all finish times in one list, sorted, cut at the budget. Only the hashes
    that shuffle the rows are Spark's."""
    units = mixing.measured(docs).groupBy("source", *mixing.UNIT).count()
    places = F.pmod(F.xxhash64("order", *mixing.UNIT), F.lit(isqrt(units.count())))
    rows = mixing.measured(docs).withColumn("order", mixing.shuffled(1)).withColumn("place", places)
    rows = [r.asDict() for r in rows.select("source", *mixing.UNIT, "order", "place").collect()]
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: float(cycle[i % len(cycle)]) for i, s in enumerate(names)}
    targets = _level(sizes, weights, repeats)
    level = max(t / weights[s] for s, t in targets.items())
    queue = []
    for rank, source in enumerate(names):
        upto = 0
        own = [r for r in rows if r["source"] == source]
        for r in sorted(own, key=lambda r: (r["place"], r["order"])):
            upto += r["size"]
            r["copies"] = 0
            for turn in range(repeats):
                finish = (turn * sizes[source] + upto) / weights[source]
                if r["size"] and finish - r["size"] / weights[source] < level - 1e-9:
                    queue.append((finish, rank, len(queue), r))
    left = sum(sizes.values())
    for _, _, _, r in sorted(queue, key=lambda q: q[:3]):
        left -= r["size"]
        if left < 0:
            break
        r["copies"] += 1
    return Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in rows)


def _repeating(spark):
    """500 rows without a doc_id of two texts, 300 of one doc_id, and others."""
    rng = random.Random(5)
    rows = [(None, " ".join(["w"] * 8) + "x" * (i % 2), "a") for i in range(500)]
    rows += [(7, " ".join(["v"] * 6), "b")] * 300
    rows += [(100 + i, " ".join(words(rng, rng.randint(1, 9))), "ab"[i % 2] + "c") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).cache()


def test_the_queue_equals_one_kept_by_hand(odd, spark):
    for docs in (odd.select("doc_id", "text", "source"), _repeating(spark)):
        found = mixing.fair_queue(docs).collect()
        assert Counter((r["doc_id"], r["source"], r["size"], r["copies"]) for r in found) == _by_hand(docs)


def test_repeated_rows_come_near_the_target(spark):
    rows = mixing.fair_queue(_repeating(spark)).collect()
    assert len(rows) == 840
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 9 for s, t in target.items())
    mixed = Counter(r["source"] for r in mixing.mixed(_repeating(spark)).collect())
    assert mixed == Counter({s: sum(r["copies"] for r in rows if r["source"] == s) for s in taken})


def test_mixed_rows_keep_their_columns(odd):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    copies = Counter((r["doc_id"], r["source"], split_words(r["text"])) for r in out.collect())
    wanted = Counter()
    for r in mixing.fair_queue(odd).collect():
        wanted[r["doc_id"], r["source"], r["size"]] += r["copies"]
    assert copies == +wanted


def test_nothing_to_mix(no_docs):
    assert mixing.taken_words(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_only_empty_texts(odd):
    rows = mixing.taken_words(odd.where("doc_id IN (1, 2, 3)")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 3
