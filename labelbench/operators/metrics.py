"""Metrics of scored rows, each in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelbench.operators.ranges import by_range
from labelbench.shared import cut

REPORT = ["n", "n_pos", "n_neg", "n_errors", "test_error", "roc", "pr"]


def pairs(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """(prediction, label) as doubles."""
    return scored.select(
        F.col(prediction).cast("double").alias("prediction"),
        F.col(label).cast("double").alias("label"),
    )


def is_error() -> Column:
    return F.col("prediction") != F.col("label")


def mispredictions(scored: DataFrame) -> DataFrame:
    """Rows whose prediction differs from the label. Rows with a null in either are no errors."""
    return scored.where(is_error())


def binary_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts, error rate and areas under ROC and PR of *predicted classes*, one row per group.

    Both areas come from four counts. A 0/1 prediction gives a ROC curve with one inner point,
    so its area is ``(1 + TPR - FPR) / 2``; the PR curve starts at (0, first precision), which is
    Spark's present rule (older versions started at (0, 1)). Rows with a null label or prediction
    are left out; the areas are null unless both classes occur; rates are null on no rows.
    """
    p, y = F.col("prediction"), F.col("label")
    counts = (
        scored.where(p.isNotNull() & y.isNotNull())
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.count_if(y == 1).alias("n_pos"),
            F.count_if(y == 0).alias("n_neg"),
            F.count_if(p != y).alias("n_errors"),
            F.count_if((p == 1) & (y == 1)).alias("tp"),
            F.count_if((p == 1) & (y == 0)).alias("fp"),
        )
    )
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    recall = F.try_divide("tp", "n_pos")
    fall_out = F.try_divide("fp", "n_neg")
    base_rate = F.try_divide(F.col("n_pos"), F.col("n_pos") + F.col("n_neg"))
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), base_rate)
    return counts.select(
        *by,
        "n",
        "n_pos",
        "n_neg",
        "n_errors",
        F.try_divide("n_errors", "n").alias("test_error"),
        F.when(both, (1 + recall - fall_out) / 2).alias("roc"),
        F.when(
            both, recall * precision + (1 - recall) * (precision + base_rate) / 2
        ).alias("pr"),
    )


def model_report(scored: DataFrame, model: str) -> DataFrame:
    """The report of one model as a row that starts with its name."""
    return binary_report(scored).select(F.lit(model).alias("model"), *REPORT)


def ranked_roc(
    df: DataFrame,
    score: str,
    label: str = "label",
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Exact area under ROC of *ranked scores*: n_pos, n_neg, roc, one row per group.

    Scores shrink to one row per distinct value first, so a score shared by a third of the rows is
    one row. These are range-partitioned and cumulated inside each range; a range then adds
    ``positives * negatives in lower ranges``, which needs one row per range and group. No window
    ever spans all scores.
    """
    by = list(by)
    # Conditions sit inside the counts: a filter on the score would compute it twice per row.
    y, ranked = F.col(label), F.col(score).isNotNull()
    counts = cut(
        df.groupBy(*by, F.col(score).alias("score")).agg(
            F.count_if((y == 1) & ranked).cast("double").alias("pos"),
            F.count_if((y == 0) & ranked).cast("double").alias("neg"),
        )
    )
    below = (
        Window.partitionBy("part", *by)
        .orderBy("score")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = (
        by_range(counts, [*by, "score"], partitions)
        .withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0.0)))
        .groupBy("part", *by)
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("inside"),
        )
    )
    # One row per range and group from here on.
    lower = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.withColumn("lower", F.coalesce(F.sum("neg").over(lower), F.lit(0.0)))
        .groupBy(*by)
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("inside") + F.col("pos") * F.col("lower")).alias("area"),
        )
        .select(
            *by,
            F.coalesce(F.col("pos").cast("bigint"), F.lit(0)).alias("n_pos"),
            F.coalesce(F.col("neg").cast("bigint"), F.lit(0)).alias("n_neg"),
            F.try_divide(F.col("area"), F.col("pos") * F.col("neg")).alias("roc"),
        )
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Row count per (label, prediction)."""
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def within_tolerance(
    scored: DataFrame, tolerance: float, by: Sequence[str] = ("label",)
) -> DataFrame:
    """Hits at a fixed tolerance and mean absolute deviation per group.

    A prediction hits when it differs from the label by at most ``tolerance``.
    """
    gap = F.abs(F.col("prediction") - F.col("label"))
    return scored.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(gap <= tolerance).alias("n_within"),
        F.avg(gap).alias("mad"),
    )


def mean_absolute_deviation(scored: DataFrame) -> DataFrame:
    """n and the mean of |prediction - label|."""
    gap = F.abs(F.col("prediction") - F.col("label"))
    return scored.agg(F.count(gap).alias("n"), F.avg(gap).alias("mad"))
