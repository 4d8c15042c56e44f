"""Trees as columns: equal to the library's models, row by row and tree by tree."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from labelbench.operators import pipelines, splits, tree_columns
from labelbench.operators.classifiers import estimator
from labelbench.operators.features import assemble
from labelbench.shared import cut
from labelbench.sources import TEXT_FEATURES, text_samples

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def samples(spark):
    return cut(splits.stable_layout(text_samples(spark, FOLDER), "doc_id", 2))


@pytest.fixture(scope="module")
def vectors(samples):
    return cut(assemble(samples, TEXT_FEATURES))


def _fitted(vectors, name, **params):
    return estimator(name, seed=7, **params).fit(vectors)


def _own(model, vectors, names=TEXT_FEATURES):
    scored = tree_columns.with_prediction(vectors, model, names)
    return {r["doc_id"]: (r["prediction"], r["prediction_sum"]) for r in scored.collect()}


@pytest.mark.parametrize(
    ("name", "params"),
    [
        ("decision_tree", {"maxDepth": 6}),
        ("random_forest", {"numTrees": 15}),
        ("boosted_trees", {"maxIter": 6}),
        ("forest_regression", {"numTrees": 9}),
    ],
)
def test_predictions_equal_the_models(vectors, name, params):
    model = _fitted(vectors, name, **params)
    wanted = {r["doc_id"]: r["prediction"] for r in model.transform(vectors).collect()}
    own = _own(model, vectors)
    assert {d: p for d, (p, _) in own.items()} == pytest.approx(wanted, abs=1e-12)
    if name == "random_forest":
        raw = {r["doc_id"]: r["rawPrediction"].toArray() for r in model.transform(vectors).collect()}
        assert all(own[d][1] == raw[d].tolist() for d in raw)


@pytest.mark.parametrize("kind", [DecisionTreeRegressor, GBTRegressor])
def test_regressions_equal_the_models(vectors, kind):
    model = kind(labelCol="f_chars", maxDepth=4, seed=7).fit(vectors)
    wanted = {r["doc_id"]: r["prediction"] for r in model.transform(vectors).collect()}
    assert {d: p for d, (p, _) in _own(model, vectors).items()} == pytest.approx(wanted)


def test_categorical_splits(spark):
    rows = [(i, float(i % 5), float(i % 7), float(i % 5 in (1, 3))) for i in range(300)]
    df = assemble(spark.createDataFrame(rows, "doc_id long, kind double, size double, label double"), ["kind", "size"])
    indexed = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=5).fit(df)
    df = indexed.transform(df).drop("features").withColumnRenamed("indexed", "features")
    model = estimator("decision_tree", maxDepth=3).fit(df)
    assert "in {" in model.toDebugString
    # The index is in order of the values, so these are their own indices.
    assert {d: p for d, (p, _) in _own(model, df, ["kind", "size"]).items()} == {r[0]: r[3] for r in rows}


def test_nan_goes_right_and_null_is_null(spark, vectors):
    model = _fitted(vectors, "random_forest", numTrees=5)
    odd = spark.createDataFrame(
        [(1, 5.0, float("nan"), 1.0, 2.0, 3.0), (2, None, 1.0, 1.0, 1.0, 1.0), (3, float("inf"), 0.0, 0.0, 0.0, -1.0)],
        ["doc_id", *TEXT_FEATURES],
    )
    own = _own(model, odd)
    wanted = model.transform(assemble(odd, TEXT_FEATURES, handle_invalid="keep")).collect()
    assert own[2] == (None, None)
    assert {r["doc_id"]: r["prediction"] for r in wanted if r["doc_id"] != 2} == {d: own[d][0] for d in (1, 3)}


def test_the_plan_has_no_functions_and_no_vectors(samples, vectors):
    for name in ("random_forest", "boosted_trees"):
        model = _fitted(vectors, name)
        scored = tree_columns.with_prediction(samples, model, TEXT_FEATURES).select("doc_id", "prediction")
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "UDF" not in plan and "Python" not in plan and "vector" not in plan
        assert scored.count() == samples.count()


def test_only_the_features_in_use_are_read(samples):
    few = cut(assemble(samples, TEXT_FEATURES[:1]))
    model = estimator("decision_tree", maxDepth=2).fit(few)
    scored = tree_columns.with_prediction(samples, model, TEXT_FEATURES[:1]).select("prediction")
    schema = scored._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
    assert "f_chars" in schema and "f_punct" not in schema


def test_stages_of_a_forest_equal_forests_of_its_first_trees(vectors):
    model = _fitted(vectors, "random_forest", numTrees=6)
    rows = tree_columns.with_stages(vectors, model, TEXT_FEATURES).collect()
    total = {r["doc_id"]: np.zeros(2) for r in rows}
    label = {r["doc_id"]: r["label"] for r in rows}
    wrong = []
    for stage, tree in enumerate(model.trees):
        for r in tree.transform(vectors).collect():
            total[r["doc_id"]] = total[r["doc_id"]] + r["probability"].toArray()
        wanted = {d: float(np.argmax(t)) for d, t in total.items()}
        assert {r["doc_id"]: r["stages"][stage] for r in rows} == wanted
        wrong.append(sum(wanted[d] != label[d] for d in wanted))
    report = tree_columns.error_by_stage(tree_columns.with_stages(vectors, model, TEXT_FEATURES), 6)
    assert [(r["n_trees"], r["n_errors"]) for r in report.orderBy("n_trees").collect()] == list(
        enumerate(wrong, start=1)
    )
    assert len(set(wrong)) > 1


def test_stages_of_boosting_equal_truncated_models(vectors):
    model = _fitted(vectors, "boosted_trees", maxIter=5)
    rows = tree_columns.with_stages(vectors, model, TEXT_FEATURES).collect()
    total = {r["doc_id"]: 0.0 for r in rows}
    for stage, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        for r in tree.transform(vectors).collect():
            total[r["doc_id"]] += weight * r["prediction"]
        assert {r["doc_id"]: r["stages"][stage] for r in rows} == {d: float(t > 0) for d, t in total.items()}
    last = {r["doc_id"]: r["prediction"] for r in model.transform(vectors).collect()}
    assert {r["doc_id"]: r["stages"][-1] for r in rows} == last


def test_votes_equal_the_trees(vectors):
    model = _fitted(vectors, "random_forest", numTrees=8)
    ones = {r["doc_id"]: 0 for r in vectors.collect()}
    for tree in model.trees:
        for r in tree.transform(vectors).collect():
            ones[r["doc_id"]] += int(r["prediction"])
    features = [F.col(f) for f in TEXT_FEATURES]
    counted = vectors.withColumn("votes", tree_columns.votes(model, features)).collect()
    assert {r["doc_id"]: r["votes"] for r in counted} == ones
    found = sorted(tuple(r) for r in pipelines.vote(model, vectors).collect())
    label = {r["doc_id"]: r["label"] for r in counted}
    assert found == sorted((float(n * 2 > 8), label[d]) for d, n in ones.items())


def test_other_models_are_refused(vectors):
    model = estimator("naive_bayes").fit(vectors)
    with pytest.raises(TypeError, match="no tree"):
        tree_columns.with_prediction(vectors, model, TEXT_FEATURES)
