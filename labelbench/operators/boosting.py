"""Boosted trees fitted to cells of rows.

Spark bins the features once, by thresholds from 10,000 rows, and from then on its trees see bins. Rows of
one label that fall into the same bin of every feature keep the same residual in all iterations, so they
are one row with a weight: any number of rows is at most labels * bins ** features cells.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelbench.operators.features import assemble
from labelbench.operators.pipelines import fit
from labelbench.shared import cut

SAMPLED_ROWS = 10_000  # that Spark takes thresholds from, or the square of its bins
ROWS_PER_TASK = 100_000
DRAWS = 1 << 30


def thresholds(counts: Iterable[tuple[float, int]], bins: int) -> list[float]:
    """Spark's thresholds of a continuous feature with so many rows of each value: between all values, or
    where the rows are parted most evenly into ``bins``."""
    counts = sorted(counts)
    middles = [(a + b) / 2 for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(middles) < bins:
        return middles
    stride = sum(n for _, n in counts) / bins
    found, seen, target = [], counts[0][1], stride
    for middle, (_, n) in zip(middles, counts[1:]):
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            found.append(middle)
            target += stride
    return found


def _unpacked(df: DataFrame, features: str) -> DataFrame:
    """Adds ``_values``, the features as an array that is made once."""
    once = df.withColumn("_once", F.array(vector_to_array(features)))
    return once.withColumn("_values", F.explode("_once")).drop("_once")


def _limits(train: DataFrame, key: str, features: str, rows: int, bins: int, seed: int) -> list[list[float]]:
    """The thresholds of each feature, from all rows or from about as many as Spark looks at.

    Rows are chosen by key and features, and counted by value, so equal ones take no more room.
    """
    most, chosen = max(bins**2, SAMPLED_ROWS), _unpacked(train, features)
    if rows > most:
        drawn = F.pmod(F.xxhash64(F.lit(seed), F.lit("thresholds"), key, "_values"), F.lit(DRAWS))
        chosen = chosen.where(drawn < int(DRAWS * most / rows))
    values = chosen.select(F.posexplode("_values").alias("feature", "value"))
    counts = defaultdict(list)
    for feature, value, n in values.groupBy("feature", "value").count().collect():
        counts[feature].append((value, n))
    return [thresholds(counts[feature], min(bins, rows)) for feature in sorted(counts)]


def _bin(value: Column, limits: list[float], low: int, high: int) -> Column:
    """How many limits lie below ``value``, when it is from ``low`` to ``high``."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    upper, lower = _bin(value, limits, middle + 1, high), _bin(value, limits, low, middle)
    return F.when(value > limits[middle], upper).otherwise(lower)


def _binned(df: DataFrame, features: str, limits: list[list[float]]) -> DataFrame:
    """Adds ``_bin0``, ``_bin1``, ...: how many thresholds of each feature lie below it."""
    bins = {
        f"_bin{i}": _bin(F.get("_values", F.lit(i)), of, 0, len(of)) for i, of in enumerate(limits)
    }
    return _unpacked(df, features).withColumns(bins).drop("_values")


class CellModel(Model):
    """A model of bins, for rows of features."""

    def __init__(self, model: Model, features: str, limits: list[list[float]]):
        super().__init__()
        self.model, self.features, self.limits = model, features, limits

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = [f"_bin{i}" for i in range(len(self.limits))]
        bins = assemble(_binned(dataset, self.features, self.limits), names, "_bins")
        return self.model.transform(bins).drop("_bins", *names)


def _counts_rows(estimator: GBTClassifier, train: DataFrame) -> bool:
    """Whether the fit depends on more of a row than its bins, its label and how often it is there."""
    attributes = train.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (
        estimator.getSubsamplingRate() < 1
        or estimator.getMinInstancesPerNode() > 1
        or estimator.isSet(estimator.weightCol)
        or estimator.isSet(estimator.validationIndicatorCol)
        or any(kind != "numeric" for kind in attributes)
    )


def fit_boosted(estimator: GBTClassifier, train: DataFrame, key: str) -> Model:
    """Fit boosted trees to the cells of ``train``, whose rows are told apart by ``key``.

    The trees are those of a fit to the rows, but for the order of sums, and but for the 10,000 rows
    that give the thresholds where there are more. Settings that look at single rows are fitted to rows.
    """
    rows = train.count()
    if not rows or _counts_rows(estimator, train):
        return fit(estimator, train)
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    limits = _limits(train, key, features, rows, estimator.getMaxBins(), estimator.getSeed())
    if not limits:
        return fit(estimator, train)
    names = [f"_bin{i}" for i in range(len(limits))]
    cells = cut(
        _binned(train, features, limits).groupBy(label, *names).agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    )
    even = cells.repartition(cells.count() // ROWS_PER_TASK + 1, *names)
    even = assemble(even.sortWithinPartitions(*names, label), names, "_bins")
    weighted = estimator.copy({estimator.weightCol: "_rows", estimator.featuresCol: "_bins"})
    return CellModel(fit(weighted, even), features, limits)
