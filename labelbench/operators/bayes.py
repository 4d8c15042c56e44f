"""Multinomial Naive Bayes in closed form: a model is a handful of sums per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelbench.functions.hashing import fold_of

SMOOTHING = 1.0


def _sum_of(terms: Sequence[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _not_negative(feature: str) -> Column:
    """The feature, or an error where it is negative."""
    error = F.raise_error(F.lit(f"negative value in {feature}"))
    return F.when(F.col(feature) < 0, error).otherwise(F.col(feature))


def fit_naive_bayes(
    df: DataFrame, features: Sequence[str], smoothing: float = SMOOTHING
) -> DataFrame:
    """One row per class: ``label``, ``log_prior`` and one log weight per feature.

    One aggregation over the samples; features must not be negative. Rows without a label are left
    out.
    """
    known = df.where(F.col("label").isNotNull())
    sums = known.groupBy("label").agg(
        F.count("*").alias("n"), *[F.sum(_not_negative(f)).alias(f) for f in features]
    )
    classes = Window.partitionBy()  # one row per class
    k, d = F.count("*").over(classes), len(features)
    total = F.sum("n").over(classes)
    mass = _sum_of([F.col(f) for f in features])
    return sums.select(
        "label",
        (F.ln(F.col("n") + smoothing) - F.ln(total + k * smoothing)).alias("log_prior"),
        *[
            (F.ln(F.col(f) + smoothing) - F.ln(mass + d * smoothing)).alias(f)
            for f in features
        ],
    )


def model_rows(model: DataFrame, features: Sequence[str]) -> DataFrame:
    """The model as (label, log_prior, feature, log_weight) rows."""
    return model.unpivot(["label", "log_prior"], list(features), "feature", "log_weight")


def predict_naive_bayes(df: DataFrame, model: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``margin`` (positive favours 1; null unless the classes are 0 and 1) and ``prediction``.

    The fitted rows, one per class as in any fitted model, become literals in one projection: no
    join, no Python. A row with a null feature gets null for both.
    """
    rows = model.orderBy("label").collect()
    if not rows:
        raise ValueError("a model needs a class")
    scores = [
        _sum_of([F.lit(row["log_prior"])] + [F.lit(row[f]) * F.col(f) for f in features])
        for row in rows
    ]
    # The best score wins, the lower label on a tie.
    if [row["label"] for row in rows] == [0.0, 1.0]:
        margin = F.col("margin")
        return df.withColumn("margin", scores[1] - scores[0]).withColumn(
            "prediction", F.when(margin > 0, 1.0).when(margin.isNotNull(), 0.0)
        )
    best = F.array_max(
        F.array(
            *[
                F.struct(score.alias("score"), F.lit(-row["label"]).alias("minus_label"))
                for score, row in zip(scores, rows)
            ]
        )
    )
    return df.withColumn("margin", F.lit(None).cast("double")).withColumn(
        "prediction", F.when(best["score"].isNotNull(), F.lit(0.0) - best["minus_label"])
    )


def cross_validate_naive_bayes(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    smoothings: Sequence[float] = (0.5, 1.0, 2.0),
    folds: int = 3,
) -> DataFrame:
    """Error of every (smoothing, fold) and the smoothing with the least mean error.

    One pass sums every fold; the training sums of a fold are the totals less its own, so all
    models of the search come from that pass. A second pass scores each row with the models of its
    fold. ``df`` is read twice: give stored rows (:func:`labelbench.shared.cut`). Labels are 0 and
    1, others are an error, as are negative features; rows without a label are left out, and rows
    with a null feature count as no error.
    """
    other = F.raise_error(F.lit("labels must be 0 or 1"))
    label = F.when(F.col("label").isin(0, 1), F.col("label")).otherwise(other)
    rows = (
        df.where(F.col("label").isNotNull())
        .withColumn("label", label)
        .withColumn("fold", fold_of(key, folds))
    )
    sums = rows.groupBy("fold").agg(
        *[F.count_if(F.col("label") == c).alias(f"n_{c}") for c in (0, 1)],
        *[
            F.sum(F.when(F.col("label") == c, _not_negative(f)).otherwise(0.0)).alias(f"{f}_{c}")
            for f in features
            for c in (0, 1)
        ],
    )
    everywhere = Window.partitionBy()  # one row per fold
    others = sums.select(
        "fold",
        *[
            (F.sum(c).over(everywhere) - F.col(c)).alias(c)
            for c in sums.columns
            if c != "fold"
        ],
    ).withColumn("smoothing", F.explode(F.array(*[F.lit(float(s)) for s in smoothings])))
    s, d = F.col("smoothing"), len(features)

    def weights(c: int) -> list[Column]:
        mass = _sum_of([F.col(f"{f}_{c}") for f in features])
        n = F.col("n_0") + F.col("n_1")
        return [(F.ln(F.col(f"n_{c}") + s) - F.ln(n + 2 * s)).alias(f"prior_{c}")] + [
            (F.ln(F.col(f"{f}_{c}") + s) - F.ln(mass + d * s)).alias(f"w_{f}_{c}")
            for f in features
        ]

    models = others.select("fold", "smoothing", *weights(0), *weights(1))
    # Broadcast: exactly folds * len(smoothings) rows, whatever the data.
    scored = rows.join(F.broadcast(models), "fold")
    score = [
        _sum_of([F.col(f"prior_{c}")] + [F.col(f"w_{f}_{c}") * F.col(f) for f in features])
        for c in (0, 1)
    ]
    wrong = F.when(score[1] > score[0], 1.0).when(score[1] <= score[0], 0.0) != F.col("label")
    errors = scored.groupBy("smoothing", "fold").agg(
        F.count("*").alias("n"), F.count_if(wrong).alias("n_errors")
    )
    # folds * len(smoothings) rows from here on.
    search = errors.withColumn("test_error", F.col("n_errors") / F.col("n")).withColumn(
        "mean_error", F.round(F.avg("test_error").over(Window.partitionBy("smoothing")), 9)
    )
    first = F.min(F.struct("mean_error", "smoothing")).over(Window.partitionBy())
    return search.withColumn("best", F.col("smoothing") == first["smoothing"])
