"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelbench.functions.labels import good_label, good_label_udf
from labelbench.operators import bayes, boosting, metrics, pipelines, profile, splits, tuning
from labelbench.operators.classifiers import DEEP_TREES, estimator
from labelbench.operators.features import assemble, explode_vector, frequency_indexer
from labelbench.operators.gini import binned_gini_splits, gini_splits, pruned_gini_splits
from labelbench.shared import balanced, cut, scratch_path
from labelbench.sources.delimited import (
    BAD_LINE,
    drop_header,
    parse_lines,
    read_delimited,
    read_lines,
    split_bad_lines,
)
from labelbench.sources.tables import TEXT_FEATURES, table, text_samples

Query = Callable[[SparkSession, str], DataFrame]

# Quantities and sizes run from 1 to 50: good from the middle on.
GOOD_SIZE_FROM = 25
ITEM_FEATURES = ["l_extendedprice", "l_discount", "l_tax"]
SEED = 11
PARALLEL_FITS = 4
# A forest keeps some bytes per row and tree, 1.2 KB for 300 trees.
ROWS_PER_TASK = 100_000
# Fits of up to 40 trees take larger parts once there are enough parts for every core.
ROWS_PER_LARGE_TASK = 1_000_000
SMALL_TASKS = 64
# A pass of 300 deep trees takes seconds per 10,000 rows: a fit that runs alone is spread over cores.
ROWS_PER_SMALL_TASK = 25_000
SPREAD_TASKS = 16


def _quality(column: str):
    return F.floor(column).cast("int")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with ``label`` from the quantity; rows without a quantity are left out."""
    return (
        table(spark, folder, "lineitem")
        .where(F.col("l_quantity").isNotNull())
        .withColumn("label", good_label(_quality("l_quantity"), GOOD_SIZE_FROM))
    )


def _stored_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents, measured once and stored: every fit and score reads the small rows."""
    return cut(balanced(text_samples(spark, folder)))


def _parts(rows: int, least: int = 1, few_trees: bool = False) -> int:
    """How many parts so many rows are laid out in: no part grows with the rows."""
    if few_trees:
        small, enough, large = ROWS_PER_TASK, SMALL_TASKS, ROWS_PER_LARGE_TASK
    else:
        small, enough, large = ROWS_PER_SMALL_TASK, SPREAD_TASKS, ROWS_PER_TASK
    return max(least, min(rows // small + 1, enough), rows // large + 1)


def _laid_out(stored: DataFrame, key: str, least: int = 1, few_trees: bool = False) -> DataFrame:
    """Stored rows in a layout that depends on the rows alone, so that seeded forests repeat.

    It is made anew by each reader. Once stored, its parts would not come back as they were: a scan
    packs small files together, the more of them the more files there are.
    """
    return splits.stable_layout(stored, key, _parts(stored.count(), least, few_trees))


def _vector_split(spark: SparkSession, folder: str, seeded: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, test) of stored labelled vectors, in a layout of their own for models with a seed."""
    samples = assemble(balanced(text_samples(spark, folder)), TEXT_FEATURES)
    stored = cut(samples.select("doc_id", "label", "features"))
    return splits.hash_split(_laid_out(stored, "doc_id") if seeded else stored, "doc_id")


SEPARABLE_FEATURES = ["f_discount", "l_tax", "f_quantity"]


def _separable_items(spark: SparkSession, folder: str, seeded: bool = True) -> DataFrame:
    """Every line item, labelled by its discount, which is also a feature: 11 values, split in the
    middle. Any of the classifiers can tell the classes apart without an error."""
    items = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"),
        F.when(F.col("l_discount") >= 0.045, 1.0).otherwise(0.0).alias("label"),
        (F.col("l_discount") - 0.045).alias("f_discount"),
        "l_tax",
        (F.col("l_quantity") / 50).alias("f_quantity"),
    )
    return _laid_out(cut(items), "key", few_trees=True) if seeded else cut(items)


def _separable_split(spark: SparkSession, folder: str, seeded: bool = True) -> tuple[DataFrame, DataFrame]:
    rows = assemble(_separable_items(spark, folder, seeded), SEPARABLE_FEATURES)
    return splits.hash_split(rows.select("key", "label", "features"), "key")


URGENCY_FEATURES = ["f_priority", "f_price"]


def _urgent_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of every order, ``good`` when of the two highest of five priorities, with the
    priority among the features. Both features are looked at in every node of a forest."""
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.when(priority <= 2, 1.0).otherwise(0.0).alias("good"),
        (priority - 2.5).alias("f_priority"),
        (F.col("o_totalprice") / 100_000).alias("f_price"),
    )
    return splits.hash_split(_laid_out(cut(orders), "key"), "key")


def _without_pipeline(rows: DataFrame) -> DataFrame:
    """The same rows for a bare classifier."""
    labelled = assemble(rows.withColumnRenamed("good", "label"), URGENCY_FEATURES)
    return labelled.select("key", "label", "features")


# --- scans and parsing -------------------------------------------------------------------------


def threshold_label(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .withColumn("quality", _quality("l_quantity"))
        .withColumn("good", good_label("quality", GOOD_SIZE_FROM))
        .select("l_orderkey", "l_linenumber", "quality", "good")
    )


def threshold_label_udf(spark: SparkSession, folder: str) -> DataFrame:
    label = good_label_udf(GOOD_SIZE_FROM)
    return table(spark, folder, "part").select("p_partkey", "p_size", label("p_size").alias("good"))


def _parsed_items(spark: SparkSession, folder: str, n_features: int | None) -> DataFrame:
    fields = [F.col(c).cast("string") for c in ITEM_FEATURES]
    fields.append(_quality("l_quantity").cast("string"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat_ws(";", *[F.coalesce(f, F.lit("")) for f in fields]).alias("value"),
    )
    parsed = parse_lines(lines, n_features, GOOD_SIZE_FROM, permissive=True)
    return parsed.where(~F.col("malformed"))


def parse_delimited(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _parsed_items(spark, folder, len(ITEM_FEATURES))
        .withColumn("values", vector_to_array("features"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "label",
            *[F.get("values", F.lit(i)).alias(name) for i, name in enumerate(ITEM_FEATURES)],
        )
    )


def parse_any_width(spark: SparkSession, folder: str) -> DataFrame:
    return explode_vector(
        _parsed_items(spark, folder, None), ["l_orderkey", "l_linenumber", "label"]
    )


def header_removed(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "headed-lines")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    table(spark, folder, "orders").select(columns).write.csv(path, sep=";", header=True)
    return drop_header(read_lines(spark, path)).select(F.col("value").alias("line"))


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "headed-csv")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    orders.write.csv(path, sep=";", header=True)
    scanned = read_delimited(spark, path, schema=orders.schema, header=True, permissive=True)
    return split_bad_lines(scanned)[0]


def csv_scan_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "inferred-csv")
    table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice").write.csv(
        path, sep=";", header=True
    )
    return read_delimited(spark, path, header=True).select(
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_size",
        "p_retailprice",
        good_label("p_size", GOOD_SIZE_FROM).alias("good"),
    )


# --- features, labels, splits ------------------------------------------------------------------


def assembled_features(spark: SparkSession, folder: str) -> DataFrame:
    return explode_vector(assemble(text_samples(spark, folder), TEXT_FEATURES), ["doc_id"])


def label_index(spark: SparkSession, folder: str) -> DataFrame:
    items = _items(spark, folder).select(
        "l_orderkey", "l_linenumber", F.col("label").alias("good")
    )
    return frequency_indexer("good", "label").fit(items).transform(items)


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_counts(splits.tag_split(table(spark, folder, "orders"), "o_orderkey"))


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return splits.tag_split(table(spark, folder, "orders"), "o_orderkey").select(
        "o_orderkey", "split"
    )


def random_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    train, test = splits.random_split(orders, seed=SEED)
    return splits.split_counts(
        train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))
    )


def random_split_cover(spark: SparkSession, folder: str) -> DataFrame:
    """What both sampled splits, with a seed and without, must keep: every order on one side."""
    orders = cut(table(spark, folder, "orders").select("o_orderkey"))
    reports = []
    for seeded in (True, False):
        train, test = splits.random_split(orders, seed=SEED if seeded else None)
        sides = train.withColumn("side", F.lit(1)).union(test.withColumn("side", F.lit(2)))
        # Stored: an unseeded sample must not be drawn twice.
        sides = cut(sides.groupBy("o_orderkey").agg(F.count_distinct("side").alias("sides")))
        whole = orders.join(sides, "o_orderkey", "left").agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("sides") > 1).alias("in_both"),
            F.count_if(F.col("sides").isNull()).alias("in_neither"),
        )
        reports.append(whole.select(F.lit(seeded).alias("seeded"), "*"))
    return reports[0].union(reports[1])


def held_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Counts over train rows, read as they are and held in memory."""
    train, _ = splits.hash_split(_items(spark, folder), "l_orderkey")
    train = train.select("l_orderkey", "label")
    count = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("n_pos")]
    plain = train.agg(*count).first()
    with pipelines.held(train) as rows:
        held = rows.agg(*count).first()
    return spark.createDataFrame(
        [(False, *plain), (True, *held)], "held boolean, n bigint, n_pos bigint"
    )


def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Well-formed and malformed lines, read as lines and as delimited rows.

    The key spoils some: those of keys ending in 3 lose a field, in 7 one is no number.
    """
    fields = [F.col(c).cast("string") for c in ITEM_FEATURES]
    last = F.col("l_orderkey") % 10
    first = F.when(last == 7, F.lit("x")).otherwise(fields[0])
    kept = F.when(last != 3, _quality("l_quantity").cast("string"))
    lines = table(spark, folder, "lineitem").select(
        F.concat_ws(";", first, *fields[1:], kept).alias("value")
    )
    path = scratch_path(spark, "spoiled-lines")
    lines.write.text(path)
    parsed = parse_lines(
        read_lines(spark, path), len(ITEM_FEATURES), GOOD_SIZE_FROM, permissive=True
    ).select(F.lit("line").alias("form"), "malformed")
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in ITEM_FEATURES])
    schema = schema.add("quality", T.IntegerType())
    scanned = read_delimited(
        spark, path, schema=schema, permissive=True
    ).select(F.lit("row").alias("form"), F.col(BAD_LINE).isNotNull().alias("malformed"))
    return parsed.union(scanned).groupBy("form", "malformed").agg(F.count(F.lit(1)).alias("n"))


def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_size", "p_retailprice", good_label("p_size", GOOD_SIZE_FROM).alias("good")
    )
    return splits.preview(parts, 3, ["p_partkey"])


def preview_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first labelled vectors. Rows are cut before vectors are built."""
    parts = table(spark, folder, "part").where("p_size IS NOT NULL AND p_retailprice IS NOT NULL")
    first = assemble(splits.preview(parts, 3, ["p_partkey"]), ["p_size", "p_retailprice"])
    samples = first.withColumn("label", good_label("p_size", GOOD_SIZE_FROM))
    return explode_vector(samples, ["p_partkey", "label"])


def fold_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return splits.split_counts(splits.with_folds(orders, "o_orderkey"), "fold")


def param_grid(spark: SparkSession, folder: str) -> DataFrame:
    """How many labelled rows each fit of the published search trains and validates on."""
    labels = table(spark, folder, "labels").where(F.col("quality").isNotNull())
    train, _ = splits.hash_split(labels, "doc_id")
    sizes = splits.split_counts(splits.with_folds(train, "doc_id"), "fold")
    folds = Window.partitionBy()  # one row per fold
    return tuning.with_grid(
        sizes.select(
            "fold",
            F.col("n").alias("n_valid"),
            (F.sum("n").over(folds) - F.col("n")).alias("n_train"),
        )
    )


# --- closed forms ------------------------------------------------------------------------------


def nb_model(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = splits.hash_split(text_samples(spark, folder), "doc_id")
    model = bayes.model_rows(bayes.fit_naive_bayes(train, TEXT_FEATURES), TEXT_FEATURES)
    return model.select(
        "label",
        "feature",
        F.round("log_prior", 6).alias("log_prior"),
        F.round("log_weight", 6).alias("log_weight"),
    )


def _nb_scored(spark: SparkSession, folder: str) -> DataFrame:
    train, test = splits.hash_split(_stored_samples(spark, folder), "doc_id")
    model = bayes.fit_naive_bayes(train, TEXT_FEATURES)
    return bayes.predict_naive_bayes(test, model, TEXT_FEATURES)


def nb_predict(spark: SparkSession, folder: str) -> DataFrame:
    return _nb_scored(spark, folder).select(
        "doc_id", "label", "prediction", F.round("margin", 6).alias("margin")
    )


def nb_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = splits.hash_split(_stored_samples(spark, folder), "doc_id")
    return bayes.cross_validate_naive_bayes(train, TEXT_FEATURES, "doc_id").select(
        "smoothing",
        "fold",
        "n",
        "n_errors",
        F.round("test_error", 6).alias("test_error"),
        F.round("mean_error", 6).alias("mean_error"),
        "best",
    )


def gini_split(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(gini_splits(text_samples(spark, folder), TEXT_FEATURES), ["gain"])


def gini_split_binned(spark: SparkSession, folder: str) -> DataFrame:
    """Discount and tax have fewer values than a tree has bins, so the bins are exact."""
    items = _items(spark, folder).select("label", "l_discount", "l_tax")
    return _rounded(binned_gini_splits(items, ["l_discount", "l_tax"]), ["threshold", "gain"])


def gini_split_items(spark: SparkSession, folder: str) -> DataFrame:
    items = _items(spark, folder).select("label", *ITEM_FEATURES)
    return _rounded(pruned_gini_splits(items, ITEM_FEATURES), ["threshold", "gain"])


# --- metrics -----------------------------------------------------------------------------------


def _rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _rounded_report(report: DataFrame) -> DataFrame:
    return _rounded(report, ["test_error", "roc", "pr"])


def mispredictions(spark: SparkSession, folder: str) -> DataFrame:
    scored = _nb_scored(spark, folder).select("doc_id", "prediction", "label")
    return metrics.mispredictions(scored)


def error_rate(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.binary_report(metrics.pairs(_nb_scored(spark, folder)))
    return _rounded(report.select("n", "n_errors", "test_error"), ["test_error"])


def hard_roc_pr(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_report(metrics.model_report(_nb_scored(spark, folder), "naive_bayes"))


def hard_roc_pr_items(spark: SparkSession, folder: str) -> DataFrame:
    """A one-rule prediction over all line items, reported per return flag."""
    scored = _items(spark, folder).select(
        "l_returnflag",
        "label",
        good_label("l_extendedprice", 50000).alias("prediction"),
    )
    return _rounded_report(metrics.binary_report(scored, ["l_returnflag"]))


def ranked_roc(spark: SparkSession, folder: str) -> DataFrame:
    scored = text_samples(spark, folder).select(
        "label", F.try_divide("f_punct", "f_chars").alias("score")
    )
    return _rounded(metrics.ranked_roc(scored, "score"), ["roc"])


def ranked_roc_items(spark: SparkSession, folder: str) -> DataFrame:
    scored = _items(spark, folder).select("l_returnflag", "label", "l_extendedprice")
    roc = metrics.ranked_roc(scored, "l_extendedprice", by=["l_returnflag"])
    return _rounded(roc, ["roc"])


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(_nb_scored(spark, folder))


# --- estimators --------------------------------------------------------------------------------


def _boosted_holdout(split: Callable, key: str) -> Query:
    """Nothing is drawn by the place of a row, so no layout is made."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        train, test = split(spark, folder, False)
        model = boosting.fit_boosted(estimator("boosted_trees", seed=SEED), train, key)
        return _rounded_report(metrics.model_report(pipelines.score(model, test), "boosted_trees"))

    return query


def _holdout(name: str, split: Callable = _vector_split) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        seeded = {"seed": SEED} if name in ("decision_tree", "random_forest") else {}
        train, test = split(spark, folder, bool(seeded))
        model = pipelines.fit(estimator(name, **seeded), train)
        return _rounded_report(metrics.model_report(pipelines.score(model, test), name))

    return query


def _vote_holdout(split: Callable) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        train, test = split(spark, folder)
        model = pipelines.fit(estimator("random_forest", seed=SEED), train)
        voted = pipelines.vote(model, test)
        return _rounded_report(metrics.model_report(voted, "random_forest, majority"))

    return query


def _good_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    samples = _stored_samples(spark, folder).withColumnRenamed("label", "good")
    return splits.hash_split(_laid_out(samples, "doc_id"), "doc_id")


def _pipeline_override(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", seed=SEED)
    params = {
        forest.numTrees: 40,
        forest.impurity: "gini",
        forest.maxDepth: 5,
        forest.maxBins: 32,
        forest.featureSubsetStrategy: "auto",
    }
    model = pipelines.fit(pipelines.build_pipeline(features, forest), train, params)
    return _rounded_report(metrics.model_report(pipelines.score(model, test), "forest pipeline"))


def rf_pipeline_override(spark: SparkSession, folder: str) -> DataFrame:
    """The whole path: samples, frequency index, vector, forest with a parameter map, report."""
    return _pipeline_override(*_good_split(spark, folder), TEXT_FEATURES)


def rf_pipeline_override_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _pipeline_override(*_urgent_orders(spark, folder), URGENCY_FEATURES)


def _pipeline(train: DataFrame, test: DataFrame, features: Sequence[str]) -> DataFrame:
    forest = estimator("random_forest", seed=SEED)
    model = pipelines.fit(pipelines.build_pipeline(features, forest), train)
    return _rounded_report(metrics.model_report(pipelines.score(model, test), "forest pipeline"))


def rf_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The same path with the parameters set on the forest."""
    return _pipeline(*_good_split(spark, folder), TEXT_FEATURES)


def rf_pipeline_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _pipeline(*_urgent_orders(spark, folder), URGENCY_FEATURES)


def _sweep(train: DataFrame, test: DataFrame) -> DataFrame:
    forest = estimator("random_forest", seed=SEED, **DEEP_TREES)
    grid = tuning.forest_grid(forest)
    return _rounded_report(tuning.sweep(forest, grid, train, test, PARALLEL_FITS))


def rf_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """All 16 points of the published grid."""
    return _sweep(*_vector_split(spark, folder))


def rf_sweep_orders(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _urgent_orders(spark, folder)
    return _sweep(_without_pipeline(train), _without_pipeline(test))


def _cross_validation(
    train: DataFrame, test: DataFrame, features: Sequence[str], key: str
) -> DataFrame:
    forest = estimator("random_forest", seed=SEED, **DEEP_TREES)
    search = tuning.cross_validate(
        pipelines.build_pipeline(features, forest),
        tuning.forest_grid(forest),
        splits.with_folds(train, key),
        label="good",
        parallelism=PARALLEL_FITS,
    )
    found = tuning.search_table(search, train)
    report = metrics.model_report(
        pipelines.score(search.model, test), tuning.point_name(search.grid[search.best])
    )
    return _rounded_report(_rounded(found.join(report, "model", "left"), ["metric"]))


def rf_cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Mean ROC of each of the 16 points through the whole pipeline, and the refitted best point's
    report on the test rows."""
    return _cross_validation(*_good_split(spark, folder), TEXT_FEATURES, "doc_id")


def rf_cross_validation_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _cross_validation(*_urgent_orders(spark, folder), URGENCY_FEATURES, "key")


def _holdout_search(train: DataFrame) -> DataFrame:
    forest = estimator("random_forest", seed=SEED, **DEEP_TREES)
    grid = tuning.forest_grid(forest)
    search = tuning.holdout_search(forest, grid, train, seed=SEED, parallelism=PARALLEL_FITS)
    return _rounded(tuning.search_table(search, train), ["metric"])


def holdout_search(spark: SparkSession, folder: str) -> DataFrame:
    return _holdout_search(_vector_split(spark, folder)[0])


def holdout_search_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _holdout_search(_without_pipeline(_urgent_orders(spark, folder)[0]))


# --- looking at features, regression -----------------------------------------------------------


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _vector_split(spark, folder)
    model = pipelines.fit(estimator("random_forest", seed=SEED), train)
    return _rounded(pipelines.feature_importance(model, TEXT_FEATURES, train), ["importance"])


def tree_importance_items(spark: SparkSession, folder: str) -> DataFrame:
    """The tree needs the discount alone."""
    train, _ = _separable_split(spark, folder)
    model = pipelines.fit(estimator("decision_tree", seed=SEED), train)
    found = pipelines.feature_importance(model, SEPARABLE_FEATURES, train)
    return _rounded(found, ["importance"])


def feature_selection(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.anova(text_samples(spark, folder), TEXT_FEATURES), ["f_value"])


def feature_correlation(spark: SparkSession, folder: str) -> DataFrame:
    samples = text_samples(spark, folder)
    return _rounded(profile.correlations(samples, ["label", *TEXT_FEATURES]), ["corr"])


def outlier_rows(spark: SparkSession, folder: str) -> DataFrame:
    samples = _stored_samples(spark, folder)
    return _rounded(profile.outliers(samples, ["doc_id"], TEXT_FEATURES), ["z"])


def group_mean(spark: SparkSession, folder: str) -> DataFrame:
    means = profile.group_mean(
        table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity"
    )
    return _rounded(means, ["mean"])


def _priced_items(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Quantity as regression target of the price."""
    rows = table(spark, folder, "lineitem").where(
        F.col("l_quantity").isNotNull() & F.col("l_extendedprice").isNotNull()
    )
    return splits.hash_split(
        rows.select("l_orderkey", F.col("l_quantity").alias("label"), "l_extendedprice"),
        "l_orderkey",
    )


def quality_regression(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _priced_items(spark, folder)
    model = estimator("linear_regression").fit(assemble(train, ["l_extendedprice"]))
    scored = pipelines.score(model, assemble(test, ["l_extendedprice"]))
    return metrics.mean_absolute_deviation(scored).select(
        F.round(F.lit(model.intercept), 6).alias("intercept"),
        F.round(F.lit(float(model.coefficients[0])), 9).alias("slope"),
        "n",
        F.round("mad", 6).alias("mad"),
    )


def _line_scored(spark: SparkSession, folder: str) -> DataFrame:
    """The same regression in closed form: one aggregation, then one projection."""
    train, test = _priced_items(spark, folder)
    line = profile.fit_line(train, "label", "l_extendedprice")
    intercept, slope = line or (None, None)  # no line, no predictions
    prediction = F.lit(intercept).cast("double") + F.lit(slope).cast("double") * F.col("l_extendedprice")
    return test.select("label", prediction.alias("prediction"))


def mad(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.mean_absolute_deviation(_line_scored(spark, folder)), ["mad"])


def confusion_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(metrics.within_tolerance(_line_scored(spark, folder), 5.0), ["mad"])


def forest_regression(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _vector_split(spark, folder)
    model = pipelines.fit(estimator("forest_regression", seed=SEED), train)
    return _rounded(metrics.mean_absolute_deviation(pipelines.score(model, test)), ["mad"])


QUERIES: dict[str, Query] = {
    "threshold_label": threshold_label,
    "threshold_label_udf": threshold_label_udf,
    "parse_delimited": parse_delimited,
    "parse_any_width": parse_any_width,
    "header_removed": header_removed,
    "csv_scan": csv_scan,
    "csv_scan_inferred": csv_scan_inferred,
    "assembled_features": assembled_features,
    "label_index": label_index,
    "split_counts": split_counts,
    "split_rows": split_rows,
    "random_split_counts": random_split_counts,
    "random_split_cover": random_split_cover,
    "held_rows": held_rows,
    "malformed_lines": malformed_lines,
    "preview_rows": preview_rows,
    "preview_samples": preview_samples,
    "fold_counts": fold_counts,
    "param_grid": param_grid,
    "nb_model": nb_model,
    "nb_predict": nb_predict,
    "nb_cross_validation": nb_cross_validation,
    "gini_split": gini_split,
    "gini_split_items": gini_split_items,
    "gini_split_binned": gini_split_binned,
    "mispredictions": mispredictions,
    "error_rate": error_rate,
    "hard_roc_pr": hard_roc_pr,
    "hard_roc_pr_items": hard_roc_pr_items,
    "ranked_roc": ranked_roc,
    "ranked_roc_items": ranked_roc_items,
    "confusion_matrix": confusion_matrix,
    "lr_holdout": _holdout("logistic_regression"),
    "dt_holdout": _holdout("decision_tree"),
    "rf_holdout": _holdout("random_forest"),
    "rf_vote_holdout": _vote_holdout(_vector_split),
    "svm_holdout": _holdout("linear_svm"),
    "gbt_holdout": _boosted_holdout(_vector_split, "doc_id"),
    "nb_holdout": _holdout("naive_bayes"),
    "rf_pipeline_override": rf_pipeline_override,
    "rf_pipeline": rf_pipeline,
    "rf_pipeline_orders": rf_pipeline_orders,
    "rf_pipeline_override_orders": rf_pipeline_override_orders,
    "rf_sweep_orders": rf_sweep_orders,
    "rf_cross_validation_orders": rf_cross_validation_orders,
    "holdout_search_orders": holdout_search_orders,
    "lr_items": _holdout("logistic_regression", _separable_split),
    "dt_items": _holdout("decision_tree", _separable_split),
    "rf_items": _holdout("random_forest", _separable_split),
    "rf_vote_items": _vote_holdout(_separable_split),
    "svm_items": _holdout("linear_svm", _separable_split),
    "gbt_items": _boosted_holdout(_separable_split, "key"),
    "tree_importance_items": tree_importance_items,
    "rf_sweep": rf_sweep,
    "rf_cross_validation": rf_cross_validation,
    "holdout_search": holdout_search,
    "feature_importance": feature_importance,
    "feature_selection": feature_selection,
    "feature_correlation": feature_correlation,
    "outlier_rows": outlier_rows,
    "group_mean": group_mean,
    "quality_regression": quality_regression,
    "mad": mad,
    "confusion_tolerance": confusion_tolerance,
    "forest_regression": forest_regression,
}
