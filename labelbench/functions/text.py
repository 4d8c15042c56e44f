"""Text measures, over the whole text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_char(text: str | Column, char: str) -> Column:
    """How often one character occurs, as double."""
    text = F.col(text) if isinstance(text, str) else text
    without = F.replace(text, F.lit(char), F.lit(""))
    return (F.length(text) - F.length(without)).cast("double")


def count_matches(text: str | Column, pattern: str) -> Column:
    """How often a pattern such as ``[A-Z]`` occurs, as double."""
    return F.regexp_count(text, F.lit(pattern)).cast("double")
