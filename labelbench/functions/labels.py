"""The quality label: 1 from a threshold on, else 0."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: a sample is good from this quality on.
GOOD_FROM = 6


def good_label(quality: str | Column, good_from: int = GOOD_FROM) -> Column:
    """0.0 below the threshold, 1.0 from it on, null for null."""
    q = F.col(quality) if isinstance(quality, str) else quality
    return F.when(q < good_from, F.lit(0.0)).when(q >= good_from, F.lit(1.0))


def good_label_udf(good_from: int = GOOD_FROM):
    """The same label as a user function. The native one is faster and can be pushed down."""

    @F.pandas_udf("double")
    def label(quality: pd.Series) -> pd.Series:
        return (quality >= good_from).astype("float64").where(quality.notna())

    return label


def register_functions(spark: SparkSession, good_from: int = GOOD_FROM) -> None:
    """Make ``good_label(quality)`` callable from SQL text."""
    spark.udf.register("good_label", good_label_udf(good_from))
