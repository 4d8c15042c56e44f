"""Types from the one reading, and the places of rejected lines."""

import shutil

from pyspark.sql import functions as F

from labelbench.sources import delimited
from labelbench.sources.inferring import column_types, read_inferred


def test_the_narrowest_type_that_holds_all(spark):
    columns = {
        "small": ["1", " -7 ", "", "+3"],
        "large": ["1", "3000000000", None, "0"],
        "huge": ["1", "30000000000000000000", "2", "3"],
        "real": ["1", "2.5e-3", ".5", "7."],
        "suffixed": ["1d", "2", "3", "4"],
        "day": ["2024-02-29", "1999-12-31", "", " "],
        "no_day": ["2023-02-29", "2024-01-01", "", ""],
        "time": ["2024-02-29 10:20", "2024-02-29T10:20:30.5", "2024-02-29", ""],
        "truth": ["true", "FALSE", "", "True"],
        "truth_and_more": ["true", "1", "", ""],
        "mixed": ["1", "x", "", ""],
        "empty": ["", " ", None, ""],
        "not a number": ["NaN", "1", "2", "3"],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{c}` string" for c in columns))
    assert column_types(df.repartition(3)) == {
        "small": "int",
        "large": "bigint",
        "huge": "double",
        "real": "double",
        "suffixed": "string",
        "day": "date",
        "no_day": "string",
        "time": "timestamp",
        "truth": "boolean",
        "truth_and_more": "string",
        "mixed": "string",
        "empty": "string",
        "not a number": "string",
    }


def test_files_are_read_once(spark, tmp_path):
    """The files may be gone when the typed rows are used."""
    folder = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", 0.5), (2, None, 1.5)], "id int, name string, x double").coalesce(1).write.csv(
        folder, sep=";", header=True
    )
    rows = read_inferred(spark, folder)
    shutil.rmtree(folder)
    assert rows.dtypes == [("id", "int"), ("name", "string"), ("x", "double")]
    assert sorted(map(tuple, rows.collect())) == [(1, "a", 0.5), (2, None, 1.5)]


def test_files_without_a_header_and_empty_ones(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("1;2.5\n;x\n")
    rows = read_inferred(spark, str(tmp_path / "plain.csv"), header=False)
    assert rows.dtypes == [("_c0", "int"), ("_c1", "string")]
    assert rows.collect()[1][0] is None
    (tmp_path / "only_header.csv").write_text("a;b\n")
    none = read_inferred(spark, str(tmp_path / "only_header.csv"))
    assert none.dtypes == [("a", "string"), ("b", "string")] and none.count() == 0


def test_rejected_lines_keep_their_file_and_reason(spark, tmp_path):
    (tmp_path / "one.txt").write_text("1;2;7\n1;x;7\n1;2\n")
    (tmp_path / "two.txt").write_text("3;4;5\n\n1;2;7;8\n")
    lines = delimited.read_placed_lines(spark, str(tmp_path))
    found = delimited.rejected_lines(lines, 2).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["value"], r["reason"]) for r in found) == [
        ("one.txt", "1;2", "fields"),
        ("one.txt", "1;x;7", "value"),
        ("two.txt", "", "fields"),
        ("two.txt", "1;2;7;8", "fields"),
    ]
    assert {r["block"] for r in found} == {0}
    counts = delimited.rejects_by_file(lines, 2).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["n_lines"], r["n_malformed"]) for r in counts) == [
        ("one.txt", 3, 2),
        ("two.txt", 3, 2),
    ]


def test_blocks_of_a_split_file(spark, tmp_path):
    """Small reads: a line's block is the part of the file that it was read with."""
    text = "".join(f"{i};{i};7\n" if i % 10 else f"bad {i}\n" for i in range(2000))
    (tmp_path / "long.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = delimited.rejected_lines(delimited.read_placed_lines(spark, str(tmp_path)), 2)
        found = rows.select("block", F.substring("value", 5, 9).cast("int").alias("i")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 200 and len({r["block"] for r in found}) > 2
    starts = {i: text.index(f"bad {i}\n") for i in range(0, 2000, 10)}
    width = min(r["block"] for r in found if r["block"])
    assert all(r["block"] <= starts[r["i"]] <= r["block"] + width for r in found)
