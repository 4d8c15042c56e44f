"""Feature columns, vectors and label indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembler(
    columns: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    """Columns to one vector. ``handle_invalid`` = error | skip | keep decides about nulls."""
    return VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid
    )


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    return assembler(columns, output, handle_invalid).transform(df)


def frequency_indexer(column: str = "good", output: str = "label") -> StringIndexer:
    """The most frequent value becomes 0.0; ties go by ascending text.

    Where good samples are the majority, label 1 therefore means *bad*.
    """
    return StringIndexer(inputCol=column, outputCol=output, stringOrderType="frequencyDesc")


def explode_vector(df: DataFrame, keys: Sequence[str], vector: str = "features") -> DataFrame:
    """One row per vector element: keys, ``position``, ``value``."""
    return df.select(*keys, F.posexplode(vector_to_array(vector)).alias("position", "value"))

