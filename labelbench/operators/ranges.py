"""Range partitions as groups, for cumulative work without one global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows that one task sorts and cumulates.
ROWS_PER_RANGE = 1_000_000


def by_range(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by ``keys`` and add the range number as ``part``, ascending with the keys.

    Meant for rows that are distinct in ``keys``: then no range can be hot. The number of ranges
    follows the number of rows, so ``df`` should be stored.
    """
    if partitions is None:
        partitions = df.count() // ROWS_PER_RANGE + 1
    return df.repartitionByRange(partitions, *keys).withColumn("part", F.spark_partition_id())
