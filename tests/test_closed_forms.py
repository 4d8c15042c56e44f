import random

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from labelbench.operators.bayes import (
    cross_validate_naive_bayes,
    fit_naive_bayes,
    predict_naive_bayes,
)
from labelbench.operators.features import assemble
from labelbench.operators.gini import binned_gini_splits, gini_splits, pruned_gini_splits
from labelbench.operators.profile import fit_line
from labelbench.operators.splits import with_folds

NAMES = ["a", "b", "c"]


def _counts(spark, classes=2, n=400):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        y = rng.randrange(classes)
        rows.append((i, float(y), *[float(rng.randrange(3 + 4 * (y == j))) for j in range(3)]))
    return spark.createDataFrame(rows, "id bigint, label double, a double, b double, c double")


@pytest.mark.parametrize("classes", [2, 3])
def test_naive_bayes_equals_the_library(spark, classes):
    df = _counts(spark, classes)
    model = fit_naive_bayes(df, NAMES)
    library = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(assemble(df, NAMES))
    rows = model.orderBy("label").collect()
    assert np.allclose([r["log_prior"] for r in rows], library.pi.toArray(), atol=1e-12)
    assert np.allclose([[r[f] for f in NAMES] for r in rows], library.theta.toArray(), atol=1e-12)
    ours = predict_naive_bayes(df, model, NAMES).select("id", "prediction")
    theirs = library.transform(assemble(df, NAMES)).select("id", F.col("prediction").alias("p"))
    assert ours.join(theirs, "id").where("prediction != p").count() == 0


def test_naive_bayes_rejects_negative_values(spark):
    df = _counts(spark).withColumn("b", F.col("b") - 1)
    with pytest.raises(Exception, match="negative value in b"):
        fit_naive_bayes(df, NAMES).collect()


def test_naive_bayes_search_equals_single_fits(spark):
    df = _counts(spark)
    folded = with_folds(df, "id")
    found = cross_validate_naive_bayes(df, NAMES, "id", (0.5, 4.0)).collect()
    assert len(found) == 6
    for row in found:
        train = folded.where(F.col("fold") != row["fold"])
        valid = folded.where(F.col("fold") == row["fold"])
        scored = predict_naive_bayes(valid, fit_naive_bayes(train, NAMES, row["smoothing"]), NAMES)
        assert row["n"] == valid.count()
        assert row["n_errors"] == scored.where("prediction != label").count()
    best = {r["smoothing"] for r in found if r["best"]}
    assert len(best) == 1
    least = min(r["mean_error"] for r in found)
    assert all((r["mean_error"] == least) for r in found if r["best"])


def test_naive_bayes_search_with_a_class_missing_from_a_fold(spark):
    df = _counts(spark).where((F.col("label") == 0) | (F.col("id") == 7))
    found = cross_validate_naive_bayes(df, NAMES, "id").collect()
    assert sum(r["n"] for r in found if r["smoothing"] == 1.0) == df.count()


def test_naive_bayes_with_labels_below_zero(spark):
    df = _counts(spark).withColumn("label", F.col("label") * 2 - 1)
    scored = predict_naive_bayes(df, fit_naive_bayes(df, NAMES), NAMES)
    plain = _counts(spark)
    wanted = predict_naive_bayes(plain, fit_naive_bayes(plain, NAMES), NAMES)
    a = {r["id"]: r["prediction"] for r in scored.collect()}
    b = {r["id"]: r["prediction"] * 2 - 1 for r in wanted.collect()}
    assert a == b and set(a.values()) == {-1.0, 1.0}
    assert scored.columns == wanted.columns


def test_naive_bayes_with_one_class_has_the_same_columns(spark):
    df = _counts(spark)
    model = fit_naive_bayes(df.where("label = 1"), NAMES)
    rows = predict_naive_bayes(df, model, NAMES).select("margin", "prediction").distinct().collect()
    assert [tuple(r) for r in rows] == [(None, 1.0)]


@pytest.mark.parametrize("classes", [2, 3])
def test_naive_bayes_gives_null_for_a_null_feature(spark, classes):
    df = _counts(spark, classes)
    model = fit_naive_bayes(df, NAMES)
    unknown = df.withColumn("b", F.when(F.col("id") != 3, F.col("b")))
    rows = predict_naive_bayes(unknown, model, NAMES).where("prediction IS NULL").collect()
    assert [r["id"] for r in rows] == [3]


def test_naive_bayes_leaves_out_null_labels(spark):
    df = _counts(spark)
    more = df.unionByName(df.limit(50).withColumn("label", F.lit(None).cast("double")))
    assert sorted(fit_naive_bayes(more, NAMES).collect()) == sorted(fit_naive_bayes(df, NAMES).collect())
    found = cross_validate_naive_bayes(more, NAMES, "id").collect()
    assert sorted(found) == sorted(cross_validate_naive_bayes(df, NAMES, "id").collect())


def test_naive_bayes_search_takes_labels_0_and_1_only(spark):
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        cross_validate_naive_bayes(_counts(spark, 3), NAMES, "id").collect()
    with pytest.raises(Exception, match="negative value in b"):
        below = _counts(spark).withColumn("b", F.col("b") - 1)
        cross_validate_naive_bayes(below, NAMES, "id").collect()


def _brute_split(rows):
    def impurity(part):
        ones = sum(part) / len(part)
        return 1 - ones**2 - (1 - ones) ** 2

    values = sorted({v for v, _ in rows})
    labels = [y for _, y in rows]
    best = None
    for low, high in zip(values, values[1:]):
        left = [y for v, y in rows if v <= low]
        right = [y for v, y in rows if v > low]
        gain = impurity(labels) - (
            len(left) * impurity(left) + len(right) * impurity(right)
        ) / len(rows)
        if best is None or round(gain, 12) > best[1]:
            best = ((low + high) / 2, round(gain, 12), len(left), len(right))
    return best


@pytest.mark.parametrize("partitions", [1, 2, 5, 40])
def test_gini_splits_equal_brute_force(spark, partitions):
    rng = random.Random(9)
    rows = [
        (float(y), 1.0 if i % 3 == 0 else rng.randrange(60) + 20.0 * y, rng.random())
        for i in range(240)
        for y in [rng.randrange(2)]
    ]
    df = spark.createDataFrame(rows, "label double, hot double, noise double")
    found = {
        r["feature"]: tuple(r)[1:]
        for r in gini_splits(df, ["hot", "noise"], partitions=partitions).collect()
    }
    for i, name in enumerate(["hot", "noise"]):
        assert found[name] == pytest.approx(_brute_split([(r[i + 1], r[0]) for r in rows]))


@pytest.mark.parametrize(("bins", "partitions"), [(4, None), (16, 3), (64, 1)])
def test_pruned_splits_equal_all_splits(spark, bins, partitions):
    """With ties, a value shared by a third of the rows, nulls, a constant and an empty column."""
    rng = random.Random(10 + bins)
    rows = []
    for i in range(2000):
        y = float(rng.random() < 0.3)
        third = 5.0 if i % 3 == 0 else rng.randrange(100) + 3.0 * y
        rows.append((y if i % 50 else None, third, rng.gauss(y, 1.0), rng.random(), 1.0, None if i % 7 else 2.0 * y))
    schema = "label double, third double, near double, noise double, same double, few double"
    df = spark.createDataFrame(rows, schema).repartition(5).withColumn("none", F.lit(None).cast("double"))
    names = ["third", "near", "noise", "same", "few", "none"]
    wanted = sorted(map(tuple, gini_splits(df, names).collect()))
    assert sorted(map(tuple, pruned_gini_splits(df, names, bins=bins, partitions=partitions).collect())) == wanted
    assert pruned_gini_splits(df.limit(0), names).count() == 0


def test_binned_splits_are_exact_for_few_values_and_near_for_many(spark):
    df = _counts(spark).withColumn("many", F.col("a") * 100 + F.col("id") % 97 + F.col("label") * 50)
    exact = {r["feature"]: r for r in gini_splits(df, [*NAMES, "many"]).collect()}
    binned = {r["feature"]: r for r in binned_gini_splits(df, [*NAMES, "many"]).collect()}
    for name in NAMES:
        assert tuple(binned[name]) == pytest.approx(tuple(exact[name]))
    assert exact["many"]["gain"] >= binned["many"]["gain"] > 0.9 * exact["many"]["gain"]
    flat = df.withColumn("flat", F.lit(1.0))
    assert binned_gini_splits(flat, ["flat"]).count() == 0
    assert binned_gini_splits(flat.limit(0), ["a"]).count() == 0


def test_gini_split_equals_a_stump(spark):
    df = _counts(spark, n=300).withColumn("a", F.col("a") * F.col("a") + F.col("label"))
    stump = DecisionTreeClassifier(maxDepth=1, maxBins=64, minInfoGain=0.0)
    model = stump.fit(assemble(df, ["a"]))
    split = gini_splits(df, ["a"]).first()
    assert f"<= {split['threshold']}" in model.toDebugString


def test_constant_feature_has_no_split(spark):
    df = _counts(spark).withColumn("same", F.lit(1.0))
    assert gini_splits(df, ["same"]).count() == 0


def test_line_equals_the_library(spark):
    df = _counts(spark)
    intercept, slope = fit_line(df, "label", "a")
    model = LinearRegression(solver="normal", labelCol="label").fit(assemble(df, ["a"]))
    assert (intercept, slope) == pytest.approx((model.intercept, model.coefficients[0]))
