"""Train/test splits, folds, previews and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelbench.functions.hashing import fold_of, is_train

WEIGHTS = (0.8, 0.2)


def random_split(
    df: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int | None = None
) -> list[DataFrame]:
    """Spark's sampled split. Repeatable only with a seed *and* an unchanged row layout."""
    return df.randomSplit(list(weights), seed)


def tag_split(df: DataFrame, key: str | Column, percent: int = 80) -> DataFrame:
    """Add ``split`` = train | test, decided by the key. A narrow projection, no shuffle."""
    return df.withColumn("split", F.when(is_train(key, percent), "train").otherwise("test"))


def hash_split(df: DataFrame, key: str | Column, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key: disjoint, covering, and the same under any layout."""
    chosen = is_train(key, percent)
    return df.where(chosen), df.where(~chosen)


def with_folds(df: DataFrame, key: str | Column, folds: int = 3) -> DataFrame:
    """Add ``fold`` = 0 .. folds - 1, decided by the key."""
    return df.withColumn("fold", fold_of(key, folds))


def split_counts(tagged: DataFrame, by: str = "split") -> DataFrame:
    """All part sizes in one pass, combined before the shuffle."""
    return tagged.groupBy(by).agg(F.count("*").alias("n"))


def preview(df: DataFrame, n: int = 3, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``n`` rows; with ``order_by`` they are the same on every run."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def stable_layout(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Fix which partition and position each row has.

    Seeded forests draw samples per partition, so only a fixed layout makes two fits equal. Rows that
    share a key are ordered by all columns, so that a second reading has them in the same places.
    """
    return df.repartition(partitions, key).sortWithinPartitions(key, F.xxhash64(*df.columns))
