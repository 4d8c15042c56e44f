"""Area under ROC from a state of fixed size that batches of rows add to.

Scores are counted in bins of equal width, positives and negatives apart. States of any batches add up to the
state of all rows, so yesterday's need not be read again. Inside a bin the order is unknown: half of its pairs
count as right, which is off by at most that half, and the state knows how much that is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024


def _bin(score: Column, low: float, high: float, bins: int) -> Column:
    place = F.floor((score - low) / (high - low) * bins)
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)).cast("int")


def roc_state(
    df: DataFrame,
    score: str,
    label: str = "label",
    by: Sequence[str] = (),
    low: float = 0.0,
    high: float = 1.0,
    bins: int = BINS,
) -> DataFrame:
    """``by``, ``bin``, ``n_pos``, ``n_neg``: at most ``bins`` rows per group, whatever the number of rows.

    Scores outside ``low`` to ``high`` count in the bins at the ends. Rows with a null or NaN score or a
    label other than 0 and 1 are left out.
    """
    value, y = F.col(score).cast("double"), F.col(label)
    ranked = df.where(value.isNotNull() & ~F.isnan(value) & y.isin(0, 1))
    return ranked.groupBy(*by, _bin(value, low, high, bins).alias("bin")).agg(
        F.count_if(y == 1).alias("n_pos"), F.count_if(y == 0).alias("n_neg")
    )


def merged(states: Sequence[DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """The state of all rows of several states with the same ends and bins."""
    every = reduce(DataFrame.unionByName, states)
    return every.groupBy(*by, "bin").agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))


def roc_of_state(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``n_pos``, ``n_neg``, ``roc``, ``bound``: the area of the scores is within ``bound`` of ``roc``.

    Both are null unless both classes occur. At most ``bins`` rows of a group meet in its window.
    """
    lower = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    pos, neg = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return (
        state.withColumn("below", F.coalesce(F.sum(neg).over(lower), F.lit(0.0)))
        .groupBy(*by)
        .agg(
            F.sum("n_pos").alias("n_pos"),
            F.sum("n_neg").alias("n_neg"),
            F.sum(pos * F.col("below")).alias("sure"),
            F.sum(pos * neg / 2).alias("half"),
        )
        .select(
            *by,
            F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
            F.coalesce("n_neg", F.lit(0)).alias("n_neg"),
            F.try_divide(F.col("sure") + F.col("half"), F.col("n_pos").cast("double") * F.col("n_neg")).alias("roc"),
            F.try_divide("half", F.col("n_pos").cast("double") * F.col("n_neg")).alias("bound"),
        )
    )


def roc_curve(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by``, ``bin``, ``fall_out``, ``recall``: the points of the curve, one per bin that holds rows, as
    rates of negatives and positives with a score in this bin or above."""
    above = Window.partitionBy(*by).orderBy(F.desc("bin"))
    whole = Window.partitionBy(*by)

    def rate(name: str) -> Column:
        return F.try_divide(F.sum(name).over(above).cast("double"), F.sum(name).over(whole).cast("double"))

    return state.select(*by, "bin", rate("n_neg").alias("fall_out"), rate("n_pos").alias("recall"))
