"""The two whole runs over sample files: raw lines through every model, and a headed table through
the forest pipeline and its cross-validated search."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelbench.functions.labels import good_label
from labelbench.operators import metrics, pipelines, splits, tuning
from labelbench.operators.classifiers import CLASSIFIERS, DEEP_TREES, estimator
from labelbench.shared import balanced, cut
from labelbench.sources.delimited import (
    FEATURES,
    SAMPLE_SCHEMA,
    parse_lines,
    read_delimited,
    read_lines,
)


@dataclass
class Run:
    """What a run shows: first samples, rows per split, one report row per model."""

    preview: DataFrame
    counts: DataFrame
    reports: DataFrame


def _split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        tagged.where(F.col("split") == "train").drop("split"),
        tagged.where(F.col("split") == "test").drop("split"),
    )


def classify_lines(
    spark: SparkSession,
    path: str,
    trees: Sequence[int] = tuning.TREES,
    depths: Sequence[int] = tuning.DEPTHS,
    seed: int | None = None,
    parallelism: int = 4,
) -> Run:
    """Headless lines: every classifier once, then the forest over the grid, all on the same rows.

    Lines have no key, so the line itself decides its split: equal lines are never on both sides.
    """
    tagged = splits.tag_split(read_lines(spark, path), "value")
    samples = cut(balanced(parse_lines(tagged)))
    train, test = _split(samples)
    # The trees vote in this run, so the forest is scored apart from the others.
    single = [name for name in CLASSIFIERS if name != "random_forest"]
    with pipelines.held(train) as rows:
        models = {
            name: pipelines.fit(_seeded(name, seed), rows) for name in (*single, "random_forest")
        }
    forest = models.pop("random_forest")
    voted = pipelines.vote(forest, test).select(
        F.lit("random_forest").alias("model"), "prediction", "label"
    )
    scored = pipelines.score_together(models, test).unionByName(voted)
    reports = metrics.binary_report(scored, ["model"]).select("model", *metrics.REPORT)
    tuned = _seeded("random_forest", seed, **DEEP_TREES)
    swept = tuning.sweep(tuned, tuning.forest_grid(tuned, trees, depths), train, test, parallelism)
    swept = swept.withColumn("model", F.concat(F.lit("random_forest, "), F.col("model")))
    return Run(
        preview=splits.preview(samples.select("label", "features")),
        counts=splits.split_counts(samples),
        reports=reports.unionByName(swept),
    )


def _seeded(name: str, seed: int | None, **params):
    """The named classifier, with the seed where it has one."""
    one = estimator(name, **params)
    return one if seed is None or not one.hasParam("seed") else one.setSeed(seed)


def classify_table(
    spark: SparkSession,
    path: str,
    trees: Sequence[int] = tuning.TREES,
    depths: Sequence[int] = tuning.DEPTHS,
    folds: int = 3,
    seed: int | None = None,
    parallelism: int = 4,
) -> Run:
    """A headed file: label, index, vector and forest as one pipeline, fitted with a parameter map;
    then the same pipeline searched over the grid with cross-validation."""
    table = read_delimited(spark, path, SAMPLE_SCHEMA, header=True).withColumn(
        "good", good_label("quality")
    )
    row = F.concat_ws(";", *[F.col(f"`{name}`") for name in SAMPLE_SCHEMA.names])
    samples = cut(balanced(splits.with_folds(splits.tag_split(table, row), row, folds)))
    train, test = _split(samples)

    forest = _seeded("random_forest", seed)
    params = {forest.numTrees: 40, forest.maxDepth: 5, forest.maxBins: 32}
    model = pipelines.fit(pipelines.build_pipeline(FEATURES, forest), train, params)
    once = metrics.model_report(pipelines.score(model, test), "forest pipeline")

    forest = _seeded("random_forest", seed, **DEEP_TREES)
    search = tuning.cross_validate(
        pipelines.build_pipeline(FEATURES, forest),
        tuning.forest_grid(forest, trees, depths),
        train,
        folds,
        label="good",
        parallelism=parallelism,
    )
    name = f"cross-validated, {tuning.point_name(search.grid[search.best])}"
    best = metrics.model_report(pipelines.score(search.model, test), name)
    return Run(
        preview=splits.preview(samples.select(*SAMPLE_SCHEMA.names, "good")),
        counts=splits.split_counts(samples),
        reports=once.unionByName(best),
    )
