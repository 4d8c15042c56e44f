"""Run a query on Spark and its SQL on DuckDB over the same tables, and compare the rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, db, sql):
    """A list of what differs; empty when both sides agree."""
    found = []
    rows = df.collect()
    cursor = db.execute(sql)
    wanted_types = {d[0]: str(d[1]) for d in cursor.description}
    wanted = cursor.fetchall()
    types = {name: SPARK_TYPES.get(kind, kind) for name, kind in df.dtypes}
    if types != wanted_types:
        found.append(f"schema {types} is not {wanted_types}")
    if len(rows) != len(wanted):
        found.append(f"{len(rows)} rows, not {len(wanted)}")
    if sorted(types) == sorted(wanted_types):
        a = _sorted_rows(rows, df.columns)
        b = _sorted_rows(wanted, list(wanted_types))
        if a != b:
            pairs = [(x, y) for x, y in zip(a, b) if x != y]
            found.append(f"{len(pairs)} rows differ, first {pairs[:2]}")
    return found
