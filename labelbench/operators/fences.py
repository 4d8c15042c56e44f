"""Outliers by quantile fences, class by class.

A value far out for its class may be ordinary for all rows, and the classes of interest are rare. So each
class has fences of its own, from quantile sketches that every partition makes and one aggregation merges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: fences stand so many interquartile ranges outside the quartiles.
REACH = 1.5
ACCURACY = 10_000


def _clean(feature: str):
    return F.when(~F.isnan(F.col(feature).cast("double")), F.col(feature).cast("double"))


def quantile_fences(
    df: DataFrame, features: Sequence[str], by: str, reach: float = REACH, accuracy: int = ACCURACY
) -> DataFrame:
    """``by``, ``feature``, ``n``, ``lower_quartile``, ``upper_quartile``, ``low``, ``high``: the fences of each
    class and feature.

    A quartile is a value of the rows whose rank is off by at most 1 / ``accuracy`` of them; with fewer rows
    of a class than ``accuracy`` it is exact. Nulls and NaN are left out. All features of all classes come
    from one aggregation, whose state per class does not grow with its rows beyond that accuracy.
    """
    quartiles = [
        F.percentile_approx(_clean(f), [0.25, 0.75], accuracy).alias(f"q{i}") for i, f in enumerate(features)
    ]
    counts = [F.count(_clean(f)).alias(f"n{i}") for i, f in enumerate(features)]
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"n{i}").alias("n"),
            F.get(f"q{i}", F.lit(0)).alias("lower_quartile"),
            F.get(f"q{i}", F.lit(1)).alias("upper_quartile"),
        )
        for i, f in enumerate(features)
    ]
    spread = F.col("upper_quartile") - F.col("lower_quartile")
    return (
        df.groupBy(by)
        .agg(*quartiles, *counts)
        .select(by, F.inline(F.array(*rows)))
        .withColumn("low", F.col("lower_quartile") - reach * spread)
        .withColumn("high", F.col("upper_quartile") + reach * spread)
    )


def outside_fences(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str],
    by: str,
    reach: float = REACH,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """``keys``, ``by``, ``feature``, ``value``, ``low``, ``high`` of the values beyond the fences of their class.

    A null class is a class of its own. NaN is outside any fences. The fences are one row per class when
    they meet the rows, so a hot class moves no rows where they are few enough to be sent.
    """
    fences = quantile_fences(df, features, by, reach, accuracy)
    of_class = fences.groupBy(F.col(by).alias("_class")).agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("low", "high")))).alias("_fences")
    )
    values = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            F.col("_fences")[f]["low"].alias("low"),
            F.col("_fences")[f]["high"].alias("high"),
        )
        for f in features
    ]
    return (
        df.join(of_class, F.col(by).eqNullSafe(F.col("_class")))
        .select(*keys, by, F.inline(F.array(*values)))
        .where((F.col("value") < F.col("low")) | (F.col("value") > F.col("high")) | F.isnan("value"))
    )
