"""Correlation of ranks, with ties, without a window over all rows.

A column shrinks to its distinct values with their counts. These are range-partitioned and counted up
inside each range; one row per range gives what lies below it. Every value then has its middle rank, and a
value that a third of the rows share is one row until its rank goes back to them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelbench.operators.profile import correlations
from labelbench.operators.ranges import by_range
from labelbench.shared import cut

# Distinct values of a column that may be sent to the tasks, 16 bytes each.
SENT_VALUES = 500_000


def middle_ranks(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """``value``, ``n``, ``rank``: for each distinct value the mean of the ranks that its rows have, from 1 on.

    Nulls have no rank. NaN is the highest value.
    """
    counts = cut(
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = by_range(counts, ["value"], partitions)
    inside = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranged = cut(ranged.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))))
    lower = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    below = (
        ranged.groupBy("part")
        .agg(F.sum("n").alias("whole"))
        .select("part", F.coalesce(F.sum("whole").over(lower), F.lit(0)).alias("below"))
    )
    rank = F.col("below") + F.col("inside") + (F.col("n") + 1) / 2
    return ranged.join(below, "part").select("value", "n", rank.alias("rank"))


def with_ranks(
    df: DataFrame, columns: Sequence[str], partitions: int | None = None, sent_values: int = SENT_VALUES
) -> DataFrame:
    """``df`` with ``rank_{column}`` of each column; null where the column is.

    Ranks of up to ``sent_values`` distinct values are sent to the rows; beyond that both are shuffled by
    the value.
    """
    for column in columns:
        ranks = cut(middle_ranks(df, column, partitions))
        ranks = ranks.select(F.col("value").alias("_value"), F.col("rank").alias(f"rank_{column}"))
        if ranks.count() <= sent_values:
            ranks = F.broadcast(ranks)
        df = df.join(ranks, F.col(column).cast("double") == F.col("_value"), "left").drop("_value")
    return df


def rank_correlations(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """(left, right, corr) of the ranks of every pair of columns, over rows that have them all."""
    rows = cut(df.select(*columns).dropna())
    ranked = with_ranks(rows, columns, **options)
    return correlations(ranked.select(*[F.col(f"rank_{c}").alias(c) for c in columns]), columns)
