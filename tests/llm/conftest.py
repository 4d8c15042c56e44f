import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).parent))

from odd_docs import odd_rows  # noqa: E402

# Names that operators use for columns of their own.
CLASHING = ["size", "shard", "rows", "part", "digest", "label", "n_lines", "score", "target", "keep_id"]


@pytest.fixture(scope="session")
def odd(spark):
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
        + [T.StructField(name, T.StringType()) for name in CLASHING]
    )
    rows = [(*row, *["x"] * len(CLASHING)) for row in odd_rows()]
    return spark.createDataFrame(rows, schema).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.limit(0)
