"""Running sums inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"


def word_count(text: str) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def running_sum(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` up to and with the row, inside its ``group``.

    The order is a shuffled one: by the bucket that a hash of ``order`` falls in, then by ``order``.
    A group of n rows has up to sqrt(N) buckets of about n / sqrt(N) rows, N being all rows, so
    neither the window over one bucket nor the one over a group's bucket totals holds a large group.
    ``df`` is read three times and should be stored. Rows that tie in ``order`` come in any order.
    No rows give no rows. ``group`` columns are not null.
    """
    keys = [*group, "_bucket"]
    buckets = max(1, isqrt(df.count()))
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy(*group).orderBy("_bucket")
    offsets = (
        placed.groupBy(*keys)
        .agg(F.sum(value).alias("_total"))
        .select(*keys, (F.sum("_total").over(before) - F.col("_total")).alias("_before"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    upto = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        placed.withColumn("_inside", upto)
        .join(offsets, keys)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_inside", "_before")
    )
