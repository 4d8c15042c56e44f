"""Column types of delimited files from the one reading that also loads them.

The files are read once, as text fields, which are stored. One aggregation of the stored fields counts for
every column how many of its values each type can hold; the narrowest type that holds all of them is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelbench.shared import cut

NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
WHOLE = r"^[+-]?[0-9]+$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?$"
# From narrow to wide; what none of them holds is text. A column of truth values holds nothing else.
LADDER = {
    "boolean": lambda v: F.lower(v).isin("true", "false"),
    "int": lambda v: v.rlike(WHOLE) & v.try_cast("int").isNotNull(),
    "bigint": lambda v: v.rlike(WHOLE) & v.try_cast("bigint").isNotNull(),
    "double": lambda v: v.rlike(NUMBER),
    "date": lambda v: v.rlike(DATE) & v.try_cast("date").isNotNull(),
    "timestamp": lambda v: (v.rlike(DATE) | v.rlike(TIME)) & v.try_cast("timestamp").isNotNull(),
}


def _trimmed(name: str) -> Column:
    value = F.trim(F.col(f"`{name}`"))
    return F.when(value != "", value)


def column_types(fields: DataFrame) -> dict[str, str]:
    """The type of every column of text fields: the first of the ladder that holds all its values, else
    string. Empty and blank fields are no values; a column without values is string."""
    if not fields.columns:
        return {}
    counts = []
    for i, name in enumerate(fields.columns):
        value = _trimmed(name)
        counts.append(F.count(value).alias(f"n{i}"))
        counts += [F.count_if(holds(value)).alias(f"{kind}{i}") for kind, holds in LADDER.items()]
    row = fields.agg(*counts).first()
    return {
        name: next((k for k in LADDER if row[f"n{i}"] and row[f"{k}{i}"] == row[f"n{i}"]), "string")
        for i, name in enumerate(fields.columns)
    }


def typed(fields: DataFrame, types: dict[str, str]) -> DataFrame:
    """The fields as their types. Text keeps its blanks; an empty field is null in any type."""
    columns = []
    for name in fields.columns:
        whole = F.col(f"`{name}`")
        kind = types[name]
        value = F.when(whole != "", whole) if kind == "string" else _trimmed(name).try_cast(kind)
        columns.append(value.alias(name))
    return fields.select(*columns)


def read_inferred(spark: SparkSession, path: str, sep: str = ";", header: bool = True) -> DataFrame:
    """Delimited files with inferred types, read once; the result reads the stored fields.

    Headed files are read by name and must have the same columns in the same order. Short rows end in nulls,
    fields beyond the header's are left out.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    names = reader.csv(path).columns  # the first line
    schema = ", ".join(f"`{n}` string" for n in names)
    fields = cut(reader.option("enforceSchema", not header).schema(schema).csv(path))
    return typed(fields, column_types(fields))
