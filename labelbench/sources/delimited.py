"""Delimited text: scans, header lines, and lines turned into labelled samples."""

from __future__ import annotations

import re

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelbench.functions.labels import GOOD_FROM, good_label

# The eleven measured columns, in file order. The target follows them.
FEATURES = [
    "fixed acidity",
    "volatile acidity",
    "citric acid",
    "residual sugar",
    "chlorides",
    "free sulfur dioxide",
    "total sulfur dioxide",
    "density",
    "pH",
    "sulphates",
    "alcohol",
]
SAMPLE_SCHEMA = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in FEATURES]
    + [T.StructField("quality", T.IntegerType())]
)
BAD_LINE = "bad_line"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value``, the ``file`` it is in and the first byte of its ``block`` there.

    A block is the part of a file that one task reads, so the place of a line is known to within it.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    return spark.read.text(path).select("value", *place)


def drop_header(lines: DataFrame, column: str = "value") -> DataFrame:
    """Remove every line equal to the first one.

    Reads a single line to learn the header. A folder of files that each carry it is covered too.
    """
    first = lines.select(column).first()
    if first is None or first[0] is None:
        return lines
    return lines.where(F.col(column) != F.lit(first[0]))


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ";",
    header: bool = False,
    permissive: bool = False,
) -> DataFrame:
    """Scan delimited files.

    With a schema the files are read once, a malformed row is an error, and ``permissive`` keeps
    such rows with their text in ``bad_line`` (see :func:`split_bad_lines`). Without a schema the
    types are inferred, which reads all files one more time: give a schema for large input.

    Headed files are read by name: fields may come in any order, and more of them, but the same
    in all files; a missing one is an error.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    wanted = [F.col(f"`{name}`") for name in schema.names]
    if header:
        names = reader.csv(path).columns
        missing = [name for name in schema.names if name not in names]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
        known = {field.name: field for field in schema.fields}
        schema = T.StructType([known.get(n, T.StructField(n, T.StringType())) for n in names])
        reader = spark.read.option("sep", sep).option("header", True).option("enforceSchema", False)
    if not permissive:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path).select(*wanted)
    flagged = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    scanned = (
        reader.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .schema(flagged)
        .csv(path)
    )
    # Whether a row is well-formed depends on all its fields, so none may be pruned away: each row
    # passes through a one-element array of the whole row.
    whole = F.struct(*[F.col(f"`{name}`") for name in flagged.names])
    return scanned.select(F.inline(F.array(whole))).select(*wanted, BAD_LINE)


def split_bad_lines(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows) of a permissive scan.

    The flag decides, not nulls: a malformed row still fills the columns that could be read.
    """
    return df.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE), df.where(F.col(BAD_LINE).isNotNull())


def parse_lines(
    lines: DataFrame,
    n_features: int | None = len(FEATURES),
    good_from: int = GOOD_FROM,
    sep: str = ";",
    column: str = "value",
    permissive: bool = False,
) -> DataFrame:
    """Lines to labelled samples: ``label`` from the last field, ``features`` from the others.

    Other columns are kept. A malformed line (wrong field count, a field that is no number, an
    empty trailing field) is an error, or with ``permissive`` a row with ``malformed`` true and
    null ``label`` and ``features``. All work is in built-in expressions. A known width is read
    field by field, in generated code; with ``n_features`` None a line may have any number of
    features, at about twice the cost.
    """
    rest = [F.col(f"`{c}`") for c in lines.columns if c != column]
    split = lines.withColumn("_fields", F.split(F.col(column), re.escape(sep), -1))
    if n_features is None:
        read = {
            "_quality": F.element_at("_fields", -1).try_cast("int"),
            "_values": F.transform(
                F.slice("_fields", F.lit(1), F.size("_fields") - 1),
                lambda field: field.try_cast("double"),
            ),
        }
        values = F.col("_values")
        well_formed = (F.size(values) > 0) & ~F.exists(values, lambda value: value.isNull())
    else:
        names = [f"_value{i}" for i in range(n_features)]
        read = {
            "_quality": F.get("_fields", F.lit(n_features)).try_cast("int"),
            "_width": F.size("_fields"),
            **{
                name: F.get("_fields", F.lit(i)).try_cast("double")
                for i, name in enumerate(names)
            },
        }
        values = F.array(*names)
        well_formed = F.col("_width") == n_features + 1
        for name in names:
            well_formed = well_formed & F.col(name).isNotNull()
    # Read through a one-element array: a filter on the outcome then stays above this step, where
    # it would otherwise be pushed below and split the line again for every field it looks at.
    fields = F.struct(*[value.alias(name) for name, value in read.items()])
    parsed = split.select(*rest, column, F.inline(F.array(fields)))
    well_formed = well_formed & F.col("_quality").isNotNull()
    well_formed = F.coalesce(well_formed, F.lit(False))
    label, features = good_label("_quality", good_from), array_to_vector(values)
    if permissive:
        return parsed.select(
            *rest,
            F.when(well_formed, label).alias("label"),
            F.when(well_formed, features).alias("features"),
            (~well_formed).alias("malformed"),
        )
    error = F.raise_error(F.concat(F.lit("malformed line: "), F.coalesce(F.col(column), F.lit(""))))
    return parsed.select(
        *rest,
        F.when(well_formed, label).otherwise(error).alias("label"),
        F.when(well_formed, features).otherwise(error).alias("features"),
    )


def rejected_lines(
    lines: DataFrame,
    n_features: int | None = len(FEATURES),
    sep: str = ";",
    column: str = "value",
) -> DataFrame:
    """The malformed lines with all their columns, and the ``reason``: ``fields`` where their number is wrong,
    else ``value``."""
    kept = lines.withColumn("_line", F.col(column))
    parsed = parse_lines(kept, n_features, sep=sep, column=column, permissive=True)
    width = F.size(F.split("_line", re.escape(sep), -1))
    wrong = width < 2 if n_features is None else width != n_features + 1
    rest = [F.col(f"`{c}`") for c in lines.columns if c != column]
    return parsed.where("malformed").select(
        *rest, F.col("_line").alias(column), F.when(wrong, "fields").otherwise("value").alias("reason")
    )


def rejects_by_file(lines: DataFrame, n_features: int | None = len(FEATURES), sep: str = ";") -> DataFrame:
    """``file``, ``n_lines``, ``n_malformed``, ``first_block`` (of a malformed line) of lines with their place."""
    parsed = parse_lines(lines, n_features, sep=sep, permissive=True)
    return parsed.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("malformed").alias("n_malformed"),
        F.min(F.when(F.col("malformed"), F.col("block"))).alias("first_block"),
    )
