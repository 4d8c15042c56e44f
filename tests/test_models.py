import threading
import weakref

import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import functions as F

from labelbench.operators import pipelines, splits, tuning
from labelbench.operators.classifiers import CLASSIFIERS, DEEP_TREES, estimator
from labelbench.operators.features import assemble
from labelbench.operators.metrics import binary_report, ranked_roc
from labelbench.shared import cut
from labelbench.sources import TEXT_FEATURES, text_samples

FOLDER = "/root/testdata/sf0.01"
SEEDED = {"decision_tree", "random_forest", "boosted_trees"}


@pytest.fixture(scope="module")
def data(spark):
    samples = assemble(text_samples(spark, FOLDER), TEXT_FEATURES)
    return splits.hash_split(cut(splits.stable_layout(samples, "doc_id", 2)), "doc_id")


@pytest.mark.parametrize("name", sorted(CLASSIFIERS))
def test_classifier_beats_the_majority(data, name):
    """Majority error is 13 of 89."""
    train, test = data
    seeded = {"seed": 11} if name in SEEDED else {}
    model = pipelines.fit(estimator(name, **seeded), train)
    row = binary_report(pipelines.score(model, test)).first()
    assert row["n"] == 89 and row["test_error"] < 13 / 89
    by_probability = name in ("decision_tree", "naive_bayes")
    score = "probability" if by_probability else "rawPrediction"
    assert tuning.ranked_evaluator(score).evaluate(model.transform(test)) > 0.7


def test_override_equals_setters(data):
    train, test = data
    plain = RandomForestClassifier(labelCol="label", featuresCol="features", seed=3)
    params = {plain.numTrees: 7, plain.maxDepth: 3, plain.maxBins: 32}
    one = pipelines.fit(plain, train, params)
    two = pipelines.fit(estimator("random_forest", seed=3, numTrees=7, maxDepth=3), train)
    assert one.getNumTrees == 7
    assert one.toDebugString.split("\n")[1:] == two.toDebugString.split("\n")[1:]


def test_pipeline_label_is_inverted_by_frequency(data):
    train, test = (df.drop("features").withColumnRenamed("label", "good") for df in data)
    model = pipelines.fit(
        pipelines.build_pipeline(TEXT_FEATURES, estimator("random_forest", seed=11)), train
    )
    row = binary_report(pipelines.score(model, test)).first()
    assert (row["n_pos"], row["n_neg"]) == (13, 76)
    assert row["test_error"] < 13 / 89


def test_deep_tree_settings_keep_the_model(data):
    train, _ = data
    plain = estimator("random_forest", seed=5, numTrees=5, maxDepth=12).fit(train)
    deep = estimator("random_forest", seed=5, numTrees=5, maxDepth=12, **DEEP_TREES).fit(train)
    assert plain.toDebugString.split("\n")[1:] == deep.toDebugString.split("\n")[1:]


def test_votes_agree_with_trees_counted_one_by_one(data):
    train, test = data
    model = estimator("random_forest", seed=5, numTrees=5, maxDepth=4).fit(train)
    voted = [r["prediction"] for r in pipelines.vote(model, test).collect()]
    rows = [r["features"] for r in test.select("features").collect()]
    assert voted == [
        float(sum(tree.predict(x) for tree in model.trees) > 2.5) for x in rows
    ]


def test_scoring_together_equals_scoring_apart(data):
    train, test = data
    models = {
        name: estimator(name).fit(train)
        for name in ("naive_bayes", "linear_svm", "logistic_regression")
    }
    together = pipelines.score_together(models, test)
    reports = {r["model"]: tuple(r)[1:] for r in binary_report(together, ["model"]).collect()}
    for name, model in models.items():
        assert reports[name] == tuple(binary_report(pipelines.score(model, test)).first())


def test_feature_importance_sums_to_one(data):
    train, _ = data
    model = estimator("random_forest", seed=11, numTrees=5).fit(train)
    rows = pipelines.feature_importance(model, TEXT_FEATURES, train).collect()
    assert [r["feature"] for r in rows] == TEXT_FEATURES
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_published_grid():
    forest_points = {(t, d) for t in tuning.TREES for d in tuning.DEPTHS}
    assert len(forest_points) == 16
    assert tuning.TREES == (10, 100, 200, 300) and tuning.DEPTHS == (5, 10, 15, 20)


def test_grid_as_maps_and_as_rows(spark):
    forest = estimator("random_forest")
    points = tuning.forest_grid(forest)
    rows = tuning.with_grid(spark.range(1)).collect()
    assert [(p[forest.numTrees], p[forest.maxDepth]) for p in points] == [
        (r["num_trees"], r["max_depth"]) for r in rows
    ]


def test_sweep_reports_every_point(data):
    train, test = data
    forest = estimator("random_forest", seed=11)
    grid = tuning.forest_grid(forest, (2, 4), (2, 3))
    report = tuning.sweep(forest, grid, train, test, parallelism=3).collect()
    assert sorted(r["model"] for r in report) == sorted(tuning.point_name(p) for p in grid)
    for point in grid:
        alone = binary_report(pipelines.score(forest.fit(train, point), test)).first()
        (row,) = [r for r in report if r["model"] == tuning.point_name(point)]
        assert tuple(row)[1:] == tuple(alone)


def test_cross_validation_equals_the_library(data):
    train, _ = data
    folded = cut(splits.stable_layout(splits.with_folds(train, "doc_id"), "doc_id", 2))
    lr = estimator("logistic_regression", maxIter=20)
    grid = [{lr.regParam: 0.0}, {lr.regParam: 0.3}]
    ours = tuning.cross_validate(lr, grid, folded, parallelism=2)
    library = CrossValidator(
        estimator=lr,
        estimatorParamMaps=grid,
        evaluator=tuning.ranked_evaluator(),
        numFolds=3,
        foldCol="fold",
    ).fit(folded)
    assert ours.metrics == pytest.approx(library.avgMetrics, abs=1e-9)
    assert list(ours.model.coefficients) == pytest.approx(
        list(library.bestModel.coefficients), rel=1e-6
    )


def test_ranking_together_equals_the_evaluator(data):
    train, test = data
    models = {
        name: estimator(name, **({"seed": 11} if name in SEEDED else {})).fit(train)
        for name in ("random_forest", "decision_tree", "logistic_regression", "naive_bayes")
    }
    ranked = ranked_roc(pipelines.rank_together(models, test), "score", by=["model"])
    found = {r["model"]: r["roc"] for r in ranked.collect()}
    for name, model in models.items():
        expected = tuning.ranked_evaluator().evaluate(model.transform(test))
        assert found[name] == pytest.approx(expected, abs=1e-12)


def test_cross_validation_takes_a_pipeline(data):
    train, test = (df.drop("features").withColumnRenamed("label", "good") for df in data)
    forest = estimator("random_forest", seed=11)
    pipeline = pipelines.build_pipeline(TEXT_FEATURES, forest)
    grid = tuning.forest_grid(forest, (3,), (2, 3))
    folded = splits.with_folds(train, "doc_id")
    found = tuning.cross_validate(pipeline, grid, folded, label="good")
    assert len(found.metrics) == 2 and found.best == found.metrics.index(max(found.metrics))
    assert binary_report(pipelines.score(found.model, test)).first()["n"] == 89
    library = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=tuning.ranked_evaluator(),
        numFolds=3,
        foldCol="fold",
    ).fit(folded)
    assert found.metrics == pytest.approx(library.avgMetrics, abs=0.02)


def test_sweep_takes_a_pipeline(data):
    train, test = (df.drop("features").withColumnRenamed("label", "good") for df in data)
    tree = estimator("decision_tree", seed=11)
    pipeline = pipelines.build_pipeline(TEXT_FEATURES, tree)
    grid = [{tree.maxDepth: d} for d in (1, 3)]
    found = {r["model"]: tuple(r)[1:] for r in tuning.sweep(pipeline, grid, train, test, 2).collect()}
    for point in grid:
        alone = binary_report(pipelines.score(pipeline.fit(train, point), test)).first()
        assert found[tuning.point_name(point)] == tuple(alone)


@pytest.mark.parametrize("parallelism", [1, 3])
def test_no_more_models_are_kept_than_are_fitted_at_once(spark, parallelism):
    class Fitted:
        def __init__(self, point):
            self.point = point

    alive, most = weakref.WeakSet(), []

    def fit(point):
        model = Fitted(point)
        alive.add(model)
        most.append(len(alive))
        return model

    grid = list(range(24))
    found = tuning.each_point(fit, lambda model: model.point * 2, grid, parallelism, spark)
    assert found == [2 * point for point in grid]
    assert max(most) <= parallelism


def test_long_fits_begin_first(spark):
    grid = tuning.forest_grid(estimator("random_forest"))
    begun = []

    def fit(point):
        begun.append(tuning.point_name(point))
        return point

    found = tuning.each_point(fit, tuning.point_name, grid, 1, spark, tuning.work)
    assert found == [tuning.point_name(point) for point in grid]
    assert begun[0] == "numTrees=300, maxDepth=20" and begun[-1] == "numTrees=10, maxDepth=5"


class Noted(RandomForestClassifier):
    """Notes the points that are fitted."""

    fitted = []

    def _fit(self, dataset):
        self.fitted.append((self.getNumTrees(), self.getMaxDepth()))
        return super()._fit(dataset)


def _two_features(spark, label):
    """400 rows: ``a`` is 0 in a quarter of them, ``b`` runs from 0 to 9."""
    rows = spark.range(400).selectExpr("id", "int(id % 4 > 0) AS a", "int(id / 4) % 10 AS b")
    rows = rows.withColumn("label", F.expr(label).cast("double"))
    return cut(splits.stable_layout(splits.with_folds(assemble(rows, ["a", "b"]), "id"), "id", 2))


def _nodes(model):
    return model.toDebugString.split("\n", 1)[1]


def test_depths_that_change_nothing_are_fitted_once(spark):
    rows = _two_features(spark, "b >= 4")
    forest = Noted(labelCol="label", featuresCol="features", seed=11)
    grid = tuning.forest_grid(forest, (2, 3), (6, 1, 4))
    Noted.fitted.clear()
    found = tuning.cross_validate(forest, grid, rows, parallelism=2)
    # Two forests a fold, and the best point again.
    assert sorted(Noted.fitted) == sorted([(2, 1), (3, 1)] * 3 + [(2, 6)])
    library = CrossValidator(
        estimator=forest,
        estimatorParamMaps=grid,
        evaluator=tuning.ranked_evaluator(),
        numFolds=3,
        foldCol="fold",
    ).fit(rows)
    assert found.metrics == library.avgMetrics
    models = tuning.each_fit(forest, rows, _nodes, grid, 2)
    assert models == [_nodes(forest.fit(rows, point)) for point in grid]


@pytest.mark.parametrize("label", ["a = 0 AND b < 4", "id % 7 < 3"])
def test_depths_that_may_change_a_forest_are_all_fitted(spark, label):
    """In the first case the shallow trees are one leaf: their only split has equal predictions."""
    rows = _two_features(spark, label)
    forest = Noted(labelCol="label", featuresCol="features", seed=11)
    grid = tuning.forest_grid(forest, (3,), (1, 2, 5))
    alone = [forest.fit(rows, point) for point in grid]
    if "AND" in label:
        assert [[tree.depth for tree in model.trees] for model in alone[:2]] == [[0] * 3, [2] * 3]
    Noted.fitted.clear()
    assert tuning.each_fit(forest, rows, _nodes, grid, 2) == [_nodes(model) for model in alone]
    assert sorted(Noted.fitted) == [(3, 1), (3, 2), (3, 5)]


def test_a_depth_too_large_is_still_an_error(spark):
    rows = _two_features(spark, "b >= 4")
    forest = estimator("random_forest", seed=11)
    with pytest.raises(Exception, match="maxDepth"):
        tuning.each_fit(forest, rows, _nodes, tuning.forest_grid(forest, (2,), (1, 31)), 1)


def test_two_layouts_give_equal_reports(spark, data):
    samples = assemble(text_samples(spark, FOLDER), TEXT_FEATURES).select("doc_id", "label", "features")
    reports = []
    for parts in (1, 5):
        rows = splits.stable_layout(cut(samples.repartition(parts)), "doc_id", 2)
        train, test = splits.hash_split(cut(rows), "doc_id")
        model = estimator("random_forest", seed=11, numTrees=10).fit(train)
        reports.append(tuple(binary_report(pipelines.score(model, test)).first()))
    assert reports[0] == reports[1]


def test_cross_validation_needs_both_classes_in_every_fold(data):
    train, _ = data
    lr = estimator("logistic_regression")
    one_sided = splits.with_folds(train, "doc_id").where(
        (F.col("fold") != 1) | (F.col("label") == 1)
    )
    with pytest.raises(ValueError, match="both classes"):
        tuning.cross_validate(lr, [{lr.regParam: 0.0}], one_sided)


def test_holdout_search_picks_the_best(data):
    train, _ = data
    lr = estimator("logistic_regression", maxIter=20)
    found = tuning.holdout_search(lr, [{lr.regParam: 0.0}, {lr.regParam: 50.0}], train, seed=1)
    assert found.metrics[found.best] == max(found.metrics)


class Watched(LogisticRegression):
    """Notes a property of its thread, and looks for it when the other fits have noted theirs."""

    together = None  # a barrier of the first two fits; the refit is alone
    kept = []

    def _fit(self, dataset):
        context = dataset.sparkSession.sparkContext
        if len(self.kept) < 2:
            own = str(self.getRegParam())
            context.setLocalProperty("test.own", own)
            Watched.together.wait(60)
            found = context.getLocalProperty("test.own") == own
            Watched.together.wait(60)
            self.kept.append(found)
        return super()._fit(dataset)


@pytest.mark.parametrize("search", ["sweep", "holdout_search"])
def test_fits_side_by_side_keep_their_own_properties(data, search):
    train, test = data
    lr = Watched(labelCol="label", featuresCol="features", maxIter=2)
    grid = [{lr.regParam: 0.0}, {lr.regParam: 0.5}]
    Watched.kept.clear()
    Watched.together = threading.Barrier(2)
    if search == "sweep":
        tuning.sweep(lr, grid, train, test, parallelism=2)
    else:
        tuning.holdout_search(lr, grid, train, seed=1, parallelism=2)
    assert Watched.kept == [True, True]


def test_holdout_search_equals_the_library(data):
    train, _ = data
    lr = estimator("logistic_regression", maxIter=20)
    grid = [{lr.regParam: 0.0}, {lr.regParam: 0.3}, {lr.regParam: 50.0}]
    ours = tuning.holdout_search(lr, grid, train, seed=1, parallelism=2)
    library = TrainValidationSplit(
        estimator=lr,
        estimatorParamMaps=grid,
        evaluator=tuning.ranked_evaluator(),
        seed=1,
    ).fit(train)
    assert ours.metrics == pytest.approx(library.validationMetrics, abs=1e-9)
    assert list(ours.model.coefficients) == pytest.approx(
        list(library.bestModel.coefficients), rel=1e-6
    )


def test_regressor(data):
    train, test = data
    model = estimator("forest_regression", seed=11, numTrees=10).fit(train)
    gap = pipelines.score(model, test).select(F.avg(F.abs(F.col("prediction") - F.col("label"))))
    assert gap.first()[0] < 0.25
