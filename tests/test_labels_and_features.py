import numpy as np
import pytest
from pyspark.sql import functions as F

from labelbench.functions import good_label, good_label_udf, register_functions
from labelbench.functions.text import count_char, count_matches
from labelbench.operators.features import assemble, explode_vector, frequency_indexer
from labelbench.operators.profile import anova, correlations, fit_line, outliers


def test_threshold_edges(spark):
    df = spark.createDataFrame([(5,), (6,), (7,), (None,)], "quality int")
    register_functions(spark)
    df.createOrReplaceTempView("threshold_edges")
    native = [r[0] for r in df.select(good_label("quality")).collect()]
    python = [r[0] for r in df.select(good_label_udf()("quality")).collect()]
    sql = [r[0] for r in spark.sql("SELECT good_label(quality) FROM threshold_edges").collect()]
    assert native == python == sql == [0.0, 1.0, 1.0, None]


@pytest.mark.parametrize(
    "values, index", [([1.0, 1.0, 1.0, 0.0], {1.0: 0.0, 0.0: 1.0}), ([1.0, 0.0], {0.0: 0.0, 1.0: 1.0})]
)
def test_label_index(spark, values, index):
    df = spark.createDataFrame([(v,) for v in values], "good double")
    rows = frequency_indexer().fit(df).transform(df).collect()
    assert {r["good"]: r["label"] for r in rows} == index


def test_null_features_stop_or_are_skipped(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0)], "id int, a double, b double")
    with pytest.raises(Exception):
        assemble(df, ["a", "b"]).collect()
    kept = assemble(df, ["a", "b"], handle_invalid="skip")
    rows = explode_vector(kept, ["id"]).collect()
    assert [(r["id"], r["position"], r["value"]) for r in rows] == [(1, 0, 1.0), (1, 1, 2.0)]


def test_character_counts(spark):
    df = spark.createDataFrame([("Ab C\nÉ.;", ), ("",), (None,)], "text string")
    rows = df.select(count_char("text", " "), count_matches("text", "[A-Z]")).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0), (0.0, 0.0), (None, None)]


def _signal(spark):
    return spark.range(200).select(
        "id",
        (F.col("id") % 2).cast("double").alias("label"),
        (F.col("id") % 2 * 10 + F.col("id") % 7).cast("double").alias("strong"),
        (F.col("id") % 5).cast("double").alias("weak"),
    )


def test_feature_selection_finds_the_signal(spark):
    rows = {r["feature"]: r for r in anova(_signal(spark), ["weak", "strong"], top=1).collect()}
    assert rows["strong"]["selected"] and not rows["weak"]["selected"]


def test_anova_equals_the_textbook(spark):
    df = _signal(spark)
    table = np.array([tuple(r) for r in df.select("label", "weak", "strong").collect()])
    found = {r["feature"]: r["f_value"] for r in anova(df, ["weak", "strong"]).collect()}
    for i, name in enumerate(["weak", "strong"], start=1):
        groups = [table[table[:, 0] == c][:, i] for c in (0, 1)]
        between = sum(len(g) * (g.mean() - table[:, i].mean()) ** 2 for g in groups)
        inside = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(table) - 2)
        assert found[name] == pytest.approx(between / inside)
    assert anova(df.where("label = 1"), ["weak"]).first()["f_value"] is None


def test_a_column_equal_to_the_label_is_selected_first(spark):
    df = _signal(spark).withColumn("same", F.col("label")).withColumn("flat", F.lit(2.0))
    rows = {r["feature"]: r for r in anova(df, ["strong", "same", "flat"], top=1).collect()}
    assert rows["same"]["selected"] and rows["same"]["f_value"] == float("inf")
    assert rows["flat"]["f_value"] is None and not rows["flat"]["selected"]


def test_one_nan_is_the_only_outlier_it_makes(spark):
    rows = [(i, float(i % 3)) for i in range(30)] + [(99, float("nan")), (100, None)]
    df = spark.createDataFrame(rows, "id int, a double")
    assert [r["id"] for r in outliers(df, ["id"], ["a"]).collect()] == [99]


def test_correlation_names_every_pair(spark):
    rows = correlations(_signal(spark), ["label", "strong", "weak"]).collect()
    assert [(r["left"], r["right"]) for r in rows] == [
        ("label", "strong"),
        ("label", "weak"),
        ("strong", "weak"),
    ]
    assert rows[0]["corr"] > 0.9


def test_outliers_and_constant_columns(spark):
    df = spark.range(100).select(
        "id", F.when(F.col("id") == 3, 1000.0).otherwise(F.col("id") % 3 * 1.0).alias("a")
    ).withColumn("b", F.lit(1.0))
    assert [(r["id"], r["feature"]) for r in outliers(df, ["id"], ["a", "b"]).collect()] == [
        (3, "a")
    ]
    assert outliers(df, ["id"], ["b"]).count() == 0


def test_line_through_points(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    intercept, slope = fit_line(df, "y", "x")
    assert (round(intercept, 9), round(slope, 9)) == (1.0, 2.0)
    assert fit_line(df.limit(0), "y", "x") is None
