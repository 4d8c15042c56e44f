"""Feature stages and an estimator fitted, scored and reported as one."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.ml import Model, Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelbench.operators.features import assembler, frequency_indexer
from labelbench.operators.metrics import pairs
from labelbench.operators.tree_columns import votes
from labelbench.shared import shared_folder


def build_pipeline(features: Sequence[str], classifier, target: str | None = "good") -> Pipeline:
    """Label index (left out when ``target`` is None), vector assembly, classifier.

    The index gives 0 to the most frequent class; without it ``label`` is used as it is.
    """
    stages = [frequency_indexer(target)] if target else []
    return Pipeline(stages=[*stages, assembler(features), classifier])


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep rows in memory, spilling to disk, while many fits read them."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def fit(pipeline, train: DataFrame, params: Mapping[Any, Any] | None = None) -> Model:
    """Fit, with ``{estimator.param: value}`` overrides.

    Spark's estimators keep their own prepared copy of the rows in memory, so a single fit reads
    ``train`` two or three times only: give stored rows rather than :func:`held` ones, which would
    be in memory twice. Many fits on the same rows are what :func:`held` is for. Boosting cuts its
    own lineage every few trees, in the shared folder.
    """
    shared_folder(train.sparkSession)
    return pipeline.fit(train, dict(params or {}))


def score(model: Model, test: DataFrame) -> DataFrame:
    """(prediction, label) of every test row."""
    return pairs(model.transform(test))


def _side_by_side(
    models: Mapping[str, Model], df: DataFrame, output: str, column: Callable[[str], Column]
) -> DataFrame:
    """(model, value, label) of every row and model from one scan of ``df``.

    Each model adds one column, named by its ``output`` parameter, with its other outputs off; the
    columns become rows at the end.
    """
    wide, rows = df, []
    for i, (name, model) in enumerate(models.items()):
        added = f"_{output}{i}"
        one = model.copy(
            {
                model.getParam(param): added if param == output else ""
                for param in ("predictionCol", "rawPredictionCol", "probabilityCol")
                if model.hasParam(param)
            }
        )
        wide = one.transform(wide)
        rows.append(F.struct(F.lit(name).alias("model"), column(added).alias("value")))
    long = wide.select("label", F.explode(F.array(*rows)).alias("_row"))
    return long.select("_row.model", "_row.value", "label")


def score_together(models: Mapping[str, Model], test: DataFrame) -> DataFrame:
    """(model, prediction, label) of every test row and model, in one scan."""
    scored = _side_by_side(models, test, "predictionCol", F.col)
    return scored.withColumnRenamed("value", "prediction")


def rank_together(
    models: Mapping[str, Model], test: DataFrame, output: str = "rawPredictionCol"
) -> DataFrame:
    """(model, score, label): the value each model gives to class 1, in one scan."""
    ranked = _side_by_side(
        models, test, output, lambda name: F.get(vector_to_array(name), F.lit(1))
    )
    return ranked.withColumnRenamed("value", "score")


def vote(forest, test: DataFrame) -> DataFrame:
    """(prediction, label) by majority of the trees; a tie goes to 0.

    The forest itself averages class probabilities, so the two can differ on single rows. The trees are
    column expressions over the assembled vector, unpacked once.
    """
    unpacked = test.select("label", F.array(vector_to_array("features")).alias("_once"))
    unpacked = unpacked.select("label", F.explode("_once").alias("_x"))
    features = [F.get("_x", F.lit(i)) for i in range(forest.numFeatures)]
    majority = F.when(votes(forest, features) * 2 > forest.getNumTrees, 1.0).otherwise(0.0)
    return unpacked.select(majority.alias("prediction"), F.col("label").cast("double").alias("label"))


def feature_importance(model, features: Sequence[str], like: DataFrame) -> DataFrame:
    """(feature, importance) of a fitted tree or forest, one row per feature."""
    values = model.featureImportances.toArray()
    return like.sparkSession.createDataFrame(
        [(name, float(value)) for name, value in zip(features, values)],
        "feature string, importance double",
    )
