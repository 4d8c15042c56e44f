import random

import pytest
from pyspark.mllib.evaluation import BinaryClassificationMetrics
from pyspark.sql import functions as F

from labelbench.operators.metrics import (
    binary_report,
    confusion_matrix,
    mean_absolute_deviation,
    mispredictions,
    ranked_roc,
    within_tolerance,
)

PAIRS = "prediction double, label double"


def _pairs(spark, tp, fp, fn, tn):
    rows = [(1.0, 1.0)] * tp + [(1.0, 0.0)] * fp + [(0.0, 1.0)] * fn + [(0.0, 0.0)] * tn
    return spark.createDataFrame(rows, PAIRS)


@pytest.mark.parametrize(
    "cells", [(40, 10, 5, 45), (5, 0, 0, 5), (0, 0, 4, 6), (4, 6, 0, 0), (1, 7, 3, 2), (0, 5, 5, 0)]
)
def test_report_equals_the_library(spark, cells):
    df = _pairs(spark, *cells)
    row = binary_report(df).first()
    library = BinaryClassificationMetrics(df.rdd.map(tuple))
    assert row["roc"] == pytest.approx(library.areaUnderROC, abs=1e-12)
    assert row["pr"] == pytest.approx(library.areaUnderPR, abs=1e-12)
    assert row["n_errors"] == cells[1] + cells[2]
    assert row["test_error"] * row["n"] == pytest.approx(row["n_errors"])
    assert mispredictions(df).count() == row["n_errors"]


def test_hand_case(spark):
    row = binary_report(_pairs(spark, 40, 10, 5, 45)).first()
    assert row["roc"] == pytest.approx(0.8535353535)
    assert row["pr"] == pytest.approx(0.7805555555)


def test_no_rows(spark):
    row = binary_report(_pairs(spark, 0, 0, 0, 0)).first()
    assert row["n"] == 0 and row["test_error"] is None and row["roc"] is None


def test_one_class_has_no_area(spark):
    row = binary_report(_pairs(spark, 3, 0, 1, 0)).first()
    assert (row["n_pos"], row["n_neg"]) == (4, 0)
    assert row["roc"] is None and row["pr"] is None and row["test_error"] == 0.25


def test_null_labels_are_left_out(spark):
    df = _pairs(spark, 1, 1, 1, 1).union(spark.createDataFrame([(1.0, None)], PAIRS))
    assert binary_report(df).first()["n"] == 4
    assert mispredictions(df).count() == 2


def _brute_roc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / len(pos) / len(neg)


@pytest.mark.parametrize("distinct", [1, 2, 7, 300])
@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ranked_roc_equals_all_pairs(spark, distinct, partitions):
    rng = random.Random(distinct)
    rows = [(rng.randrange(distinct) / 7, float(rng.random() < 0.4)) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, label double")
    row = ranked_roc(df, "score", partitions=partitions).first()
    assert row["roc"] == pytest.approx(_brute_roc(rows), abs=1e-12)
    turned = ranked_roc(df.withColumn("score", -F.col("score")), "score").first()
    assert turned["roc"] == pytest.approx(1 - row["roc"], abs=1e-12)
    shuffled = ranked_roc(df.orderBy(F.rand(3)), "score").first()
    assert shuffled["roc"] == row["roc"]


def test_ranked_roc_with_a_hot_score_and_groups(spark):
    rng = random.Random(1)
    rows = [
        (g, 0.5 if i % 3 == 0 else rng.random(), float(rng.random() < 0.5))
        for g in ("a", "b")
        for i in range(400)
    ] + [("only positives", 0.1, 1.0)]
    df = spark.createDataFrame(rows, "g string, score double, label double")
    found = {r["g"]: r for r in ranked_roc(df, "score", by=["g"]).collect()}
    for g in ("a", "b"):
        assert found[g]["roc"] == pytest.approx(_brute_roc([r[1:] for r in rows if r[0] == g]))
    assert found["only positives"]["roc"] is None and found["only positives"]["n_pos"] == 1


def test_ranked_roc_skips_nulls_and_survives_no_rows(spark):
    rows = [(None, 1.0), (0.2, None), (0.1, 0.0), (0.9, 1.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    assert tuple(ranked_roc(df, "score").first()) == (1, 1, 1.0)
    assert tuple(ranked_roc(df.limit(0), "score").first()) == (0, 0, None)


def test_scores_are_cumulated_in_ranges_only(spark):
    df = spark.range(1000).select((F.col("id") % 9).alias("score"), (F.col("id") % 2).alias("label"))
    plan = ranked_roc(df, "score", partitions=4)._jdf.queryExecution().executedPlan().toString()
    single = plan.index("SinglePartition")
    # The one single-partition step comes after rows were reduced to one per range.
    assert "rangepartitioning" in plan[single:] and plan.count("SinglePartition") == 1


def test_confusion_and_deviation(spark):
    df = spark.createDataFrame([(5.0, 5.0), (6.4, 6.0), (9.0, 6.0)], PAIRS)
    assert mean_absolute_deviation(df).first()["mad"] == pytest.approx(3.4 / 3)
    hits = {r["label"]: (r["n"], r["n_within"]) for r in within_tolerance(df, 0.5).collect()}
    assert hits == {5.0: (1, 1), 6.0: (2, 1)}
    assert sum(r["n"] for r in confusion_matrix(df).collect()) == 3
