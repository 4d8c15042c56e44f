"""The estimators by short name, with their published parameters as defaults."""

from __future__ import annotations

from typing import Any

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor

# The parameters a run uses when none are given.
CLASSIFIERS: dict[str, tuple[type, dict[str, Any]]] = {
    "logistic_regression": (
        LogisticRegression,
        {"maxIter": 100, "regParam": 0.0, "fitIntercept": False, "threshold": 0.5},
    ),
    "decision_tree": (
        DecisionTreeClassifier,
        {"impurity": "gini", "maxDepth": 5, "maxBins": 32},
    ),
    "random_forest": (
        RandomForestClassifier,
        {
            "numTrees": 40,
            "featureSubsetStrategy": "auto",
            "impurity": "gini",
            "maxDepth": 5,
            "maxBins": 32,
        },
    ),
    "linear_svm": (
        LinearSVC,
        {"maxIter": 100, "regParam": 0.01, "fitIntercept": False, "tol": 1e-3},
    ),
    "boosted_trees": (GBTClassifier, {"maxIter": 40, "maxDepth": 5, "stepSize": 0.1}),
    "naive_bayes": (NaiveBayes, {"smoothing": 1.0, "modelType": "multinomial"}),
}
REGRESSORS: dict[str, tuple[type, dict[str, Any]]] = {
    "linear_regression": (LinearRegression, {"regParam": 0.0, "solver": "normal"}),
    "forest_regression": (RandomForestRegressor, {"numTrees": 40, "maxDepth": 5, "maxBins": 32}),
}

# Deep trees: remember each row's node instead of sending the trees out on every level, and grow
# more nodes per pass over the data. Both change the cost only, not the model.
DEEP_TREES = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024}


def estimator(name: str, **params: Any):
    """An unfitted estimator over ``label`` and ``features``; ``params`` override the defaults."""
    kind, defaults = {**CLASSIFIERS, **REGRESSORS}[name]
    return kind(labelCol="label", featuresCol="features", **{**defaults, **params})
