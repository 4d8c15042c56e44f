"""Queries of the analysis operators: sensitivity, trees as columns, subgradients, fences, ranks, selection,
exact splits, inference, places of rejects, and areas from states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelbench.operators import (
    bayes,
    fences,
    metrics,
    pipelines,
    ranks,
    roc_state,
    sensitivity,
    splits,
    stepwise,
    stratify,
    subgradient,
    tree_columns,
    tuning,
)
from labelbench.operators.classifiers import estimator
from labelbench.operators.features import assemble
from labelbench.plans.queries import (
    PARALLEL_FITS,
    SEED,
    SEPARABLE_FEATURES,
    URGENCY_FEATURES,
    Query,
    _laid_out,
    _rounded,
    _rounded_report,
    _separable_items,
    _stored_samples,
    _urgent_orders,
)
from labelbench.shared import cut, scratch_path
from labelbench.sources.delimited import read_placed_lines, rejects_by_file
from labelbench.sources.inferring import read_inferred
from labelbench.sources.tables import TEXT_FEATURES, table, text_samples

# --- sensitivity -------------------------------------------------------------------------------


def nb_sensitivity(spark: SparkSession, folder: str) -> DataFrame:
    """How far the margin of Naive Bayes moves with each measure of a text."""
    train, _ = splits.hash_split(_stored_samples(spark, folder), "doc_id")
    probes = sensitivity.probe_rows(train, TEXT_FEATURES)
    scored = bayes.predict_naive_bayes(probes, bayes.fit_naive_bayes(train, TEXT_FEATURES), TEXT_FEATURES)
    ranges = sensitivity.response_ranges(scored, "margin")
    return _rounded(ranges, ["low", "high", "range", "gradient", "variance", "importance"])


def forest_sensitivity(spark: SparkSession, folder: str) -> DataFrame:
    """The same of a forest's share for class 1."""
    train, _ = splits.hash_split(_stored_samples(spark, folder), "doc_id")
    train = _laid_out(train, "doc_id")
    model = pipelines.fit(estimator("random_forest", seed=SEED), assemble(train, TEXT_FEATURES))
    scored = tree_columns.with_prediction(sensitivity.probe_rows(train, TEXT_FEATURES), model, TEXT_FEATURES)
    share = F.get("prediction_sum", F.lit(1)) / model.getNumTrees
    return sensitivity.response_ranges(scored.withColumn("share", share), "share")


# --- trees as columns --------------------------------------------------------------------------


def _fitted_to_orders(spark: SparkSession, folder: str, name: str) -> tuple:
    """(model, train, test) of urgent orders with their features as plain columns."""
    train, test = (
        side.withColumnRenamed("good", "label") for side in _urgent_orders(spark, folder)
    )
    model = pipelines.fit(estimator(name, seed=SEED), assemble(train, URGENCY_FEATURES))
    return model, train, test


def _expression_orders(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        model, _, test = _fitted_to_orders(spark, folder, name)
        scored = tree_columns.with_prediction(test, model, URGENCY_FEATURES)
        return _rounded_report(metrics.model_report(metrics.pairs(scored), f"{name}, columns"))

    return query


def _staged_orders(name: str) -> Query:
    """The error on the test rows after each number of trees of one fit."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        model, _, test = _fitted_to_orders(spark, folder, name)
        staged = tree_columns.with_stages(test, model, URGENCY_FEATURES)
        return _rounded(tree_columns.error_by_stage(staged, model.getNumTrees), ["test_error"])

    return query


def staged_forest(spark: SparkSession, folder: str) -> DataFrame:
    rows = _laid_out(_stored_samples(spark, folder), "doc_id")
    train, test = splits.hash_split(rows, "doc_id")
    model = pipelines.fit(estimator("random_forest", seed=SEED), assemble(train, TEXT_FEATURES))
    staged = tree_columns.with_stages(test, model, TEXT_FEATURES)
    return _rounded(tree_columns.error_by_stage(staged, model.getNumTrees), ["test_error"])


# --- searches whose best point is known --------------------------------------------------------

DEPTHS_IN_SEARCH = (1, 2, 3)


def _banded_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every order, good when of the second or third of five priorities: no single split tells that."""
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.when(priority.between(2, 3), 1.0).otherwise(0.0).alias("label"),
        priority.cast("double").alias("f_priority"),
    )
    rows = assemble(orders, ["f_priority"]).select("key", "label", "features")
    return _laid_out(cut(rows), "key", least=2, few_trees=True)


def _best_depth(search: tuning.Search, like: DataFrame) -> DataFrame:
    """(model, best, separates): which point won, and which rank all rows without an error."""
    found = tuning.search_table(search, like)
    return found.select("model", "best", (F.round("metric", 9) == 1).alias("separates"))


def depth_cross_validation_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = splits.with_folds(_banded_orders(spark, folder), "key")
    forest = estimator("random_forest", seed=SEED, numTrees=5)
    grid = tuning.forest_grid(forest, [5], DEPTHS_IN_SEARCH)
    search = tuning.cross_validate(forest, grid, rows, parallelism=PARALLEL_FITS)
    # The refitted best point leaves no order wrong.
    wrong = metrics.mispredictions(pipelines.score(search.model, rows)).agg(F.count(F.lit(1)).alias("n_wrong"))
    return _best_depth(search, rows).join(wrong, F.col("best"), "left")


def depth_holdout_search_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = _banded_orders(spark, folder)
    forest = estimator("random_forest", seed=SEED, numTrees=5)
    grid = tuning.forest_grid(forest, [5], DEPTHS_IN_SEARCH)
    return _best_depth(tuning.holdout_search(forest, grid, rows, seed=SEED, parallelism=PARALLEL_FITS), rows)


# --- subgradients ------------------------------------------------------------------------------


def svm_subgradient_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items told apart by their discount, on scales of a few units around 0."""
    rows = _separable_items(spark, folder, seeded=False).select(
        "key",
        "label",
        (F.col("f_discount") * 20).alias("f_discount"),
        (F.col("l_tax") * 10 - 0.4).alias("l_tax"),
        (F.col("f_quantity") - 0.5).alias("f_quantity"),
    )
    train, test = splits.hash_split(rows, "key")
    model = subgradient.svm(train, SEPARABLE_FEATURES, "key", iterations=60, batches=2)
    scored = metrics.pairs(subgradient.classified(test, model, SEPARABLE_FEATURES))
    return _rounded_report(metrics.model_report(scored, "linear_svm, subgradients"))


TUBE = 0.1


def svr_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items on an exact line: predictions are in the tube around it on average, and all as near again."""
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"),
        (F.col("l_discount") * 20 - 1).alias("x"),
        (F.col("l_tax") * 25 - 1).alias("z"),
    )
    rows = rows.withColumn("label", 0.5 + 2 * F.col("x") - F.col("z"))
    train, test = splits.hash_split(cut(rows), "key")
    model = subgradient.support_vector_regression(
        train, ["x", "z"], "key", width=TUBE, penalty=0.0, iterations=60, tolerance=0.0
    )
    scored = metrics.pairs(subgradient.regressed(test, model, ["x", "z"]))
    found = metrics.within_tolerance(scored, 2 * TUBE, by=())
    return found.select("n", "n_within", (F.col("mad") <= TUBE).alias("in_tube"))


# --- looking at features -----------------------------------------------------------------------


def fence_outliers(spark: SparkSession, folder: str) -> DataFrame:
    samples = _stored_samples(spark, folder)
    return fences.outside_fences(samples, ["doc_id"], TEXT_FEATURES, "label")


def class_fences(spark: SparkSession, folder: str) -> DataFrame:
    """Fences per return flag over all line items; quantities and discounts have few values."""
    items = table(spark, folder, "lineitem")
    found = fences.quantile_fences(items, ["l_quantity", "l_discount"], "l_returnflag", accuracy=1_000_000)
    return _rounded(found, ["lower_quartile", "upper_quartile", "low", "high"])


RANKED = ["quantity", "l_extendedprice", "l_discount", "l_tax"]


def rank_correlation_items(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the line items share the least quantity."""
    items = table(spark, folder, "lineitem").withColumn("quantity", F.greatest("l_quantity", F.lit(17)))
    return _rounded(ranks.rank_correlations(items, RANKED), ["corr"])


def rank_correlation(spark: SparkSession, folder: str) -> DataFrame:
    samples = text_samples(spark, folder)
    return _rounded(ranks.rank_correlations(samples, ["label", *TEXT_FEATURES]), ["corr"])


def stepwise_items(spark: SparkSession, folder: str) -> DataFrame:
    """The target is made of discount and tax; a copy of the discount must not come in."""
    rows = table(spark, folder, "lineitem").select(
        (3 * F.col("l_discount") + F.col("l_tax")).alias("target"),
        (100 * F.col("l_discount")).alias("copy"),
        "l_discount",
        "l_tax",
        "l_quantity",
    )
    steps = stepwise.stepwise_table(rows, "target", ["l_quantity", "l_discount", "copy", "l_tax"])
    return _rounded(steps.drop("f_value"), ["explained"])


# --- splits, scans, states ---------------------------------------------------------------------


def class_split_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return stratify.tag_class_split(orders, "o_orderkey", "o_orderpriority")


def class_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    tagged = class_split_orders(spark, folder)
    return tagged.groupBy("o_orderpriority", "split").agg(F.count(F.lit(1)).alias("n"))


def csv_scan_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers, large ones, fractions, dates, times, truth values, mixed and empty columns."""
    path = scratch_path(spark, "typed-csv")
    key = F.col("o_orderkey")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    table(spark, folder, "orders").select(
        key.cast("int").alias("whole"),
        (key * 10_000_000_000).alias("large"),
        F.col("o_totalprice").alias("price"),
        date.alias("day"),
        F.concat(date, F.lit(" 10:20:30")).alias("time"),
        (key % 2 == 0).alias("even"),
        F.when(key % 3 == 0, key.cast("string")).otherwise(F.concat(F.lit("x"), key)).alias("mixed"),
        F.lit(None).cast("string").alias("nothing"),
        F.when(key % 5 == 0, key % 100).alias("gaps"),
    ).write.csv(path, sep=";", header=True)
    typed = read_inferred(spark, path)
    return typed.select(
        *[F.col(c) for c in typed.columns if c not in ("day", "time")],
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.concat_ws(" ", F.typeof("day"), F.typeof("time")).alias("types"),
    )


def malformed_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written to a folder per line number, some spoiled by a rule on the key."""
    fields = [F.col(c).cast("string") for c in ("l_extendedprice", "l_discount", "l_tax")]
    last = F.col("l_orderkey") % 10
    spoiled = F.when(last == 7, F.lit("x")).otherwise(fields[0])
    kept = F.when(last != 3, F.floor("l_quantity").cast("string"))
    path = scratch_path(spark, "placed-lines")
    table(spark, folder, "lineitem").select(
        "l_linenumber", F.concat_ws(";", spoiled, *fields[1:], kept).alias("value")
    ).write.partitionBy("l_linenumber").text(path)
    number = F.regexp_extract("file", r"l_linenumber=(\d+)/", 1).cast("bigint")
    counts = rejects_by_file(read_placed_lines(spark, path), 3)
    return counts.groupBy(number.alias("l_linenumber")).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_malformed").alias("n_malformed")
    )


def roc_state_items(spark: SparkSession, folder: str) -> DataFrame:
    """Quantities rank returned line items, from states of four batches added up."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        (F.col("l_quantity") / 51).alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        "l_linestatus",
    )
    batches = [
        roc_state.roc_state(items.where(F.pmod("l_orderkey", F.lit(4)) == i), "score", by=["l_linestatus"], bins=32)
        for i in range(4)
    ]
    found = roc_state.roc_of_state(roc_state.merged(batches, ["l_linestatus"]), ["l_linestatus"])
    return _rounded(found, ["roc", "bound"])


QUERIES: dict[str, Query] = {
    "nb_sensitivity": nb_sensitivity,
    "forest_sensitivity": forest_sensitivity,
    "dt_expression_orders": _expression_orders("decision_tree"),
    "rf_expression_orders": _expression_orders("random_forest"),
    "gbt_expression_orders": _expression_orders("boosted_trees"),
    "rf_staged_orders": _staged_orders("random_forest"),
    "gbt_staged_orders": _staged_orders("boosted_trees"),
    "staged_forest": staged_forest,
    "depth_cross_validation_orders": depth_cross_validation_orders,
    "depth_holdout_search_orders": depth_holdout_search_orders,
    "svm_subgradient_items": svm_subgradient_items,
    "svr_items": svr_items,
    "fence_outliers": fence_outliers,
    "class_fences": class_fences,
    "rank_correlation": rank_correlation,
    "rank_correlation_items": rank_correlation_items,
    "stepwise_items": stepwise_items,
    "class_split_orders": class_split_orders,
    "class_split_counts": class_split_counts,
    "csv_scan_typed": csv_scan_typed,
    "malformed_by_file": malformed_by_file,
    "roc_state_items": roc_state_items,
}
