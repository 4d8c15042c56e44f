import pytest

from labelbench.sources import (
    BAD_LINE,
    FEATURES,
    SAMPLE_SCHEMA,
    drop_header,
    parse_lines,
    read_delimited,
    read_lines,
    split_bad_lines,
)

# Made-up samples.
GOOD = "5.5;0.25;0.5;2.75;0.125;20;40;0.75;3.25;0.5;10.5;5"
BETTER = "6.5;0.5;0.25;1.25;0.0625;30;60;0.875;3.75;0.625;11.5;6"
HEADER = ";".join(FEATURES + ["quality"])


def _lines(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def _file(folder, name, *lines):
    path = folder / name
    path.write_text("\n".join(lines))
    return str(path)


@pytest.mark.parametrize("width", [11, None])
def test_lines_become_labelled_vectors(spark, width):
    rows = parse_lines(_lines(spark, GOOD, BETTER), width).collect()
    assert [r["label"] for r in rows] == [0.0, 1.0]
    assert list(rows[0]["features"].toArray()) == [float(v) for v in GOOD.split(";")[:-1]]


@pytest.mark.parametrize(
    "bad", ["a;b;c", ";".join(GOOD.split(";")[:-1]), GOOD + ";", GOOD + ";6", "", None]
)
def test_malformed_line(spark, bad):
    lines = _lines(spark, GOOD, bad)
    with pytest.raises(Exception, match="malformed line"):
        parse_lines(lines).collect()
    rows = parse_lines(lines, permissive=True).collect()
    assert [r["malformed"] for r in rows] == [False, True]
    assert rows[1]["label"] is None and rows[1]["features"] is None


@pytest.mark.parametrize("bad", ["5;6;", "6", "x;6", "1.5;6.5"])
def test_malformed_line_of_any_width(spark, bad):
    row = parse_lines(_lines(spark, bad), None, permissive=True).first()
    assert row["malformed"]


def test_other_columns_and_separators_are_kept(spark):
    lines = spark.createDataFrame([(7, "1|2|9")], "id int, value string")
    row = parse_lines(lines, 2, sep="|").first()
    assert row["id"] == 7 and row["label"] == 1.0 and list(row["features"]) == [1.0, 2.0]


def test_line_is_split_once_even_under_a_filter(spark):
    parsed = parse_lines(_lines(spark, GOOD), permissive=True).where("NOT malformed")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_header_is_removed_everywhere(spark, tmp_path):
    _file(tmp_path, "a.csv", HEADER, GOOD, HEADER)
    _file(tmp_path, "b.csv", HEADER, BETTER)
    kept = drop_header(read_lines(spark, str(tmp_path)))
    assert sorted(r["value"] for r in kept.collect()) == sorted([GOOD, BETTER])


def test_no_lines_no_header(spark):
    assert drop_header(_lines(spark).limit(0)).count() == 0


def test_headless_scan_with_schema(spark, tmp_path):
    df = read_delimited(spark, _file(tmp_path, "a.data", GOOD, BETTER), SAMPLE_SCHEMA)
    assert df.schema == SAMPLE_SCHEMA
    assert [r["quality"] for r in df.collect()] == [5, 6]


def test_headed_scan_infers_types(spark, tmp_path):
    df = read_delimited(spark, _file(tmp_path, "a.csv", HEADER, GOOD, BETTER), header=True)
    assert df.columns == FEATURES + ["quality"]
    types = dict(df.dtypes)
    assert types["quality"] == "int" and types["density"] == "double"


def test_bad_rows_stop_or_are_flagged(spark, tmp_path):
    path = _file(tmp_path, "a.data", GOOD, "5.5;5;", BETTER + ";1", "x" + GOOD)
    with pytest.raises(Exception):
        read_delimited(spark, path, SAMPLE_SCHEMA).collect()
    scanned = read_delimited(spark, path, SAMPLE_SCHEMA, permissive=True)
    good, bad = split_bad_lines(scanned)
    assert good.columns == SAMPLE_SCHEMA.names and good.count() == 1
    assert sorted(r[BAD_LINE] for r in bad.collect()) == sorted(
        ["5.5;5;", BETTER + ";1", "x" + GOOD]
    )


@pytest.mark.parametrize("permissive", [False, True])
def test_headed_files_are_read_by_name(spark, tmp_path, permissive):
    schema = SAMPLE_SCHEMA.__class__(SAMPLE_SCHEMA.fields[:2])
    first, second = schema.names
    path = _file(tmp_path, "a.csv", f"{second};more;{first}", "1;x;2")
    row = read_delimited(spark, path, schema, header=True, permissive=permissive).first()
    assert (row[first], row[second]) == (2.0, 1.0)
    lacking = _file(tmp_path, "b.csv", second, "1")
    with pytest.raises(ValueError, match=first):
        read_delimited(spark, lacking, schema, header=True, permissive=permissive)


@pytest.mark.parametrize("permissive", [False, True])
def test_files_with_different_headers_are_an_error(spark, tmp_path, permissive):
    schema = SAMPLE_SCHEMA.__class__(SAMPLE_SCHEMA.fields[:2])
    first, second = schema.names
    _file(tmp_path, "a.csv", f"{first};{second}", "1;2")
    _file(tmp_path, "b.csv", f"{second};{first}", "1;2")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path), schema, header=True, permissive=permissive).collect()


def test_a_headed_file_keeps_its_malformed_rows_apart(spark, tmp_path):
    path = _file(tmp_path, "a.csv", HEADER, GOOD, "1;2")
    good, bad = split_bad_lines(
        read_delimited(spark, path, SAMPLE_SCHEMA, header=True, permissive=True)
    )
    assert good.count() == 1 and [r[BAD_LINE] for r in bad.collect()] == ["1;2"]
