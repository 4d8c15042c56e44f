"""Linear models by subgradients over mini-batches, with decreasing steps.

Rows fall into batches by a hash of their key and are stored batch by batch, so an iteration reads its
batch only. There each partition adds up the subgradient of its rows, one row of sums comes back, and the
driver moves the weights, a vector as long as the features. The classic solver of support vector machines
takes such steps: no bias, step / sqrt(t), weights shrunk by the L2 penalty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelbench.shared import scratch_path


@dataclass
class LinearModel:
    """Weights in the order of the features, the last one of a constant when there is a bias."""

    weights: list[float]
    biased: bool
    iterations: int
    moves: list[float] = field(default_factory=list)  # how far each iteration moved the weights

    def margin(self, features: Sequence[str]) -> Column:
        return F.expr(_dot(self.weights, _inputs(features, self.biased)))


def _inputs(features: Sequence[str], biased: bool) -> list[str]:
    return [f"CAST(`{f}` AS DOUBLE)" for f in features] + ["1D"] * biased


def _dot(weights: Sequence[float], inputs: Sequence[str]) -> str:
    """The sum as SQL text, from left to right. A single text costs one call per iteration."""
    return " + ".join(["0D", *[f"{weight!r}D * {value}" for weight, value in zip(weights, inputs)]])


def hinge(margin: str, label: str) -> str:
    """Factor of a row's subgradient: labels 0 and 1 should lie beyond -1 and 1."""
    side = f"(2 * {label} - 1)"
    return f"CASE WHEN {side} * ({margin}) < 1 THEN -{side} ELSE 0D END"


def tube(width: float):
    """Factor of a row's subgradient where only what leaves a tube of this half width costs."""

    def factor(margin: str, label: str) -> str:
        gap = f"({margin} - {label})"
        return f"CASE WHEN {gap} > {width!r}D THEN 1D WHEN {gap} < -{width!r}D THEN -1D ELSE 0D END"

    return factor


def in_batches(df: DataFrame, key: str, batches: int) -> DataFrame:
    """``df`` stored with its rows' ``batch``, 0 to batches - 1, one folder for each."""
    path = scratch_path(df.sparkSession, "batches")
    batch = F.pmod(F.xxhash64(key), F.lit(batches)).cast("int")
    df.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path)


def descend(
    df: DataFrame,
    features: Sequence[str],
    loss,
    *,
    key: str,
    label: str = "label",
    iterations: int = 100,
    step: float = 1.0,
    penalty: float = 0.01,
    batches: int = 1,
    tolerance: float = 1e-3,
    biased: bool = False,
) -> LinearModel:
    """Weights after ``iterations``, or fewer when they move by less than ``tolerance`` of their length.

    Iteration t takes the batch t - 1 modulo ``batches``, the mean subgradient of its rows and a step of
    ``step`` / sqrt(t). ``loss`` is :func:`hinge` or a :func:`tube`. Rows with a null label or feature are
    left out; a batch without rows leaves the weights as they are.
    """
    inputs = _inputs(features, biased)
    complete = df.dropna(subset=[label, *features]).select(key, label, *features)
    rows = in_batches(complete, key, batches)
    target = f"CAST(`{label}` AS DOUBLE)"
    sums_of = ["count(1) AS n", *[f"sum(factor * {x}) AS g{i}" for i, x in enumerate(inputs)]]
    model = LinearModel([0.0] * len(inputs), biased, 0)
    for t in range(1, iterations + 1):
        factor = loss(_dot(model.weights, inputs), target)
        batch = rows.where(f"batch = {(t - 1) % batches}").selectExpr("*", f"{factor} AS factor")
        sums = batch.selectExpr(*sums_of).first()
        if not sums["n"]:
            continue
        size = step / sqrt(t)
        before = model.weights
        model.weights = [w * (1 - size * penalty) - size * g / sums["n"] for w, g in zip(before, sums[1:])]
        model.iterations = t
        moved = sqrt(sum((a - b) ** 2 for a, b in zip(model.weights, before)))
        model.moves.append(moved)
        if t > 1 and moved < tolerance * max(1.0, sqrt(sum(w * w for w in model.weights))):
            break
    return model


def svm(df: DataFrame, features: Sequence[str], key: str, **options) -> LinearModel:
    """A linear support vector machine for labels 0 and 1."""
    return descend(df, features, hinge, key=key, **options)


def support_vector_regression(
    df: DataFrame, features: Sequence[str], key: str, width: float = 0.1, **options
) -> LinearModel:
    """A line that leaves as little as it can outside a tube of half width ``width``, with a bias."""
    return descend(df, features, tube(width), key=key, **{"biased": True, **options})


def classified(df: DataFrame, model: LinearModel, features: Sequence[str]) -> DataFrame:
    """``df`` with ``margin`` and ``prediction``: 1 above a margin of 0."""
    return df.withColumn("margin", model.margin(features)).withColumn(
        "prediction", F.when(F.col("margin") > 0, 1.0).when(F.col("margin") <= 0, 0.0)
    )


def regressed(df: DataFrame, model: LinearModel, features: Sequence[str]) -> DataFrame:
    return df.withColumn("prediction", model.margin(features))
