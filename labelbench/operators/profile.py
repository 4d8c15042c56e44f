"""Looking at features before training: averages, correlations, outliers."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """n and mean of a column per group."""
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(left, right, corr) of every pair of columns, all from one aggregation."""
    named = list(combinations(columns, 2))
    one_row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(named)])
    rows = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(named)
    ]
    return one_row.select(F.inline(F.array(*rows)))


def outliers(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], deviations: float = 3.0
) -> DataFrame:
    """(keys, feature, value, z) of values further than ``deviations`` from their column's mean.

    Two passes: one row of means and deviations comes back, then a filter runs over the rows.
    A constant column has no outliers. NaN is left out of the statistics and is itself an outlier.
    """
    numbers = {c: F.when(~F.isnan(c), F.col(c)) for c in columns}
    stats = df.agg(
        *[F.avg(value).alias(f"m_{c}") for c, value in numbers.items()],
        *[F.stddev_samp(value).alias(f"s_{c}") for c, value in numbers.items()],
    ).first()
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).alias("value"),
            ((F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"])).alias("z"),
        )
        for c in columns
        if stats[f"s_{c}"]
    ]
    if not rows:
        rows = [
            F.struct(
                F.lit("").alias("feature"),
                F.lit(None).cast("double").alias("value"),
                F.lit(None).cast("double").alias("z"),
            )
        ]
    return (
        df.select(*keys, F.inline(F.array(*rows)))
        .where(F.abs("z") > deviations)
        .select(*keys, "feature", "value", "z")
    )


def anova(df: DataFrame, columns: Sequence[str], label: str = "label", top: int = 3) -> DataFrame:
    """(feature, f_value, selected): how well each column tells the classes apart.

    The F value is the variance between class means over the variance inside classes: infinite for
    a column that differs between classes only, null for a constant one. The ``top`` highest are
    selected, by name on a tie. One aggregation gives everything: classes x features
    rows remain. Unlike a p-value, F does not become 0 for every useful column of a large table.
    """
    per_class = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.var_pop(c).alias(f"v_{c}") for c in columns],
    )
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"n_{c}").alias("n"),
            F.col(f"m_{c}").alias("mean"),
            F.col(f"v_{c}").alias("var"),
        )
        for c in columns
    ]
    n, mean = F.col("n"), F.col("mean")
    whole = Window.partitionBy("feature")
    overall = F.sum(n * mean).over(whole) / F.sum(n).over(whole)
    between = F.sum(n * (mean - F.col("overall")) * (mean - F.col("overall")))
    inside = F.sum(n * F.col("var"))
    f_value = F.when((inside == 0) & (between > 0), F.lit(float("inf"))).otherwise(
        F.try_divide(between / (F.count("*") - 1), F.try_divide(inside, F.sum(n) - F.count("*")))
    )
    values = (
        per_class.select(F.inline(F.array(*rows)))
        .where(n > 0)
        .withColumn("overall", overall)
        .groupBy("feature")
        .agg(F.when(F.count("*") > 1, f_value).alias("f_value"))
    )
    # One row per feature from here on.
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last("f_value"), "feature"))
    return values.select("feature", "f_value", (rank <= top).alias("selected"))


def fit_line(df: DataFrame, target: str, feature: str) -> tuple[float, float] | None:
    """(intercept, slope) of the least-squares line, in one aggregation; None if undefined."""
    line = df.agg(
        F.regr_intercept(target, feature).alias("intercept"),
        F.regr_slope(target, feature).alias("slope"),
    ).first()
    return None if line["slope"] is None else (line["intercept"], line["slope"])
