"""Fitted trees as column expressions.

A fitted tree is read once from its model and becomes one nested ``CASE``: Catalyst plans it with the
rest of the query, so scoring needs neither vectors nor functions, and the scan reads the features that
the tree really asks for. Ensembles are arrays of such columns, cumulated inside the row, which also
gives the result after each number of trees.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSIFIERS = (DecisionTreeClassificationModel, RandomForestClassificationModel)
REGRESSORS = (DecisionTreeRegressionModel, RandomForestRegressionModel)
BOOSTED = (GBTClassificationModel, GBTRegressionModel)


@dataclass(frozen=True)
class Leaf:
    """What a leaf predicts, and the weights of the classes there."""

    prediction: float
    weights: tuple[float, ...]

    def shares(self) -> list[float]:
        whole = sum(self.weights)
        return [w / whole if whole else 0.0 for w in self.weights]


@dataclass(frozen=True)
class Split:
    """Left when feature <= threshold, or, for a categorical feature, when it is one of ``left_values``."""

    feature: int
    threshold: float | None
    left_values: tuple[float, ...]
    left: Node
    right: Node


Node = Leaf | Split


def _read(node) -> Node:
    if node.subtreeDepth() == 0:
        return Leaf(float(node.prediction()), tuple(float(x) for x in node.impurityStats().stats()))
    split = node.split()
    continuous = split.getClass().getSimpleName() == "ContinuousSplit"
    return Split(
        int(split.featureIndex()),
        float(split.threshold()) if continuous else None,
        () if continuous else tuple(float(x) for x in split.leftCategories()),
        _read(node.leftChild()),
        _read(node.rightChild()),
    )


def read_tree(model) -> Node:
    """The nodes of a fitted tree. Costs a few calls per node, none per row."""
    return _read(model._call_java("rootNode"))


def trees_of(model) -> list[Node]:
    """The trees of a model, in their order; a single tree is a list of one."""
    if not isinstance(model, (*CLASSIFIERS, *REGRESSORS, *BOOSTED)):
        raise TypeError(f"{type(model).__name__} is no tree or ensemble of trees")
    return [read_tree(tree) for tree in getattr(model, "trees", [model])]


def tree_column(node: Node, features: Sequence[Column], value: Callable[[Leaf], object]) -> Column:
    """The ``value`` of the leaf that a row falls into. Splits whose sides agree are left out. NaN goes
    right, as it is above any threshold."""

    def build(node: Node) -> tuple[Column, object]:
        if isinstance(node, Leaf):
            return F.lit(value(node)), value(node)
        (left, left_value), (right, right_value) = build(node.left), build(node.right)
        if left_value is not None and left_value == right_value:
            return left, left_value
        column = features[node.feature]
        goes_left = column.isin(*node.left_values) if node.threshold is None else column <= node.threshold
        return F.when(goes_left, left).otherwise(right), None

    return build(node)[0]


def _values(model, features: Sequence[Column]) -> Column:
    """An array with one element per tree: its classes' shares, or what it adds to the sum."""
    trees = trees_of(model)
    if isinstance(model, CLASSIFIERS):
        columns = [tree_column(t, features, Leaf.shares) for t in trees]
    elif isinstance(model, REGRESSORS):
        columns = [tree_column(t, features, lambda leaf: leaf.prediction) for t in trees]
    else:
        columns = [
            tree_column(t, features, lambda leaf, w=w: w * leaf.prediction)
            for t, w in zip(trees, model.treeWeights)
        ]
    return F.array(*columns)


def _start(model) -> Column:
    return F.lit([0.0] * model.numClasses) if isinstance(model, CLASSIFIERS) else F.lit(0.0)


def _add(model, done: Column, tree: Column) -> Column:
    return F.zip_with(done, tree, lambda x, y: x + y) if isinstance(model, CLASSIFIERS) else done + tree


def _decided(model, done: Column, trees: Column) -> Column:
    """The prediction from the sum over so many ``trees``."""
    if isinstance(model, CLASSIFIERS):
        # The first of the highest, as the library has it.
        return (F.array_position(done, F.array_max(done)) - 1).cast("double")
    if isinstance(model, GBTClassificationModel):
        return F.when(done > 0, 1.0).otherwise(0.0)
    return done / trees if isinstance(model, RandomForestRegressionModel) else done


def _known(features: Sequence[Column]) -> Column:
    known = F.lit(True)
    for feature in features:
        known = known & feature.isNotNull()
    return known


def _features(names: Sequence[str]) -> list[Column]:
    return [F.col(name).cast("double") for name in names]


def with_prediction(df: DataFrame, model, names: Sequence[str], output: str = "prediction") -> DataFrame:
    """``df`` with the model's prediction from the columns ``names``, null where one of them is.

    ``names`` are in the order in which they were assembled for the fit. Also adds ``{output}_sum``: the
    sum over the trees, of class shares for trees and forests of classes.
    """
    features = _features(names)
    total = F.aggregate("_trees", _start(model), lambda done, tree: _add(model, done, tree))
    count = F.size("_trees")
    return (
        df.withColumn("_trees", F.when(_known(features), _values(model, features)))
        .withColumn(f"{output}_sum", total)
        .withColumn(output, F.when(F.col("_trees").isNotNull(), _decided(model, F.col(f"{output}_sum"), count)))
        .drop("_trees")
    )


def with_stages(df: DataFrame, model, names: Sequence[str], output: str = "stages") -> DataFrame:
    """``df`` with an array: the prediction after 1, 2, ... trees of one fit."""
    features = _features(names)
    nothing = F.struct(_start(model).alias("sum"), F.array().cast("array<double>").alias("found"))

    def step(done, tree):
        total = _add(model, done["sum"], tree)
        decided = _decided(model, total, F.size(done["found"]) + 1)
        return F.struct(total.alias("sum"), F.concat(done["found"], F.array(decided)).alias("found"))

    return (
        df.withColumn("_trees", F.when(_known(features), _values(model, features)))
        .withColumn(output, F.aggregate("_trees", nothing, step, lambda done: done["found"]))
        .drop("_trees")
    )


def error_by_stage(staged: DataFrame, n_trees: int, stages: str = "stages", label: str = "label") -> DataFrame:
    """(n_trees, n, n_errors, test_error) after each number of trees, all in one aggregation.

    Rows with a null label or feature are left out.
    """
    known = F.col(label).isNotNull() & F.col(stages).isNotNull()
    wrong = [F.count_if(known & (F.get(stages, F.lit(i)) != F.col(label))) for i in range(n_trees)]
    counts = staged.agg(F.count_if(known).alias("n"), F.array(*wrong).alias("wrong"))
    return counts.select("n", F.posexplode("wrong").alias("stage", "n_errors")).select(
        (F.col("stage") + 1).alias("n_trees"), "n", "n_errors", F.try_divide("n_errors", "n").alias("test_error")
    )


def votes(forest, features: Sequence[Column]) -> Column:
    """How many trees of a forest of two classes are for class 1."""

    def for_one(leaf: Leaf) -> int:
        return int(leaf.weights[1] > leaf.weights[0])

    columns = [tree_column(tree, features, for_one) for tree in trees_of(forest)]
    return F.aggregate(F.array(*columns), F.lit(0), lambda done, tree: done + tree)
