"""The best gini split of every feature, over all distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelbench.operators.ranges import by_range
from labelbench.shared import cut


def _impurity(zeros: Column, ones: Column) -> Column:
    n = zeros + ones
    return 1 - (zeros / n) * (zeros / n) - (ones / n) * (ones / n)


def gini_splits(
    df: DataFrame, features: Sequence[str], label: str = "label", partitions: int | None = None
) -> DataFrame:
    """Per feature: ``threshold``, ``gain``, ``n_left``, ``n_right`` of the best split.

    Thresholds are midpoints of neighbouring values, as a decision tree with enough bins uses.
    Values shrink to one row per (feature, distinct value); these are cut into ranges, cumulated
    inside each range, and completed with the totals of the lower ranges.
    """
    counts = cut(
        df.where(F.col(label).isNotNull())
        .unpivot([label], list(features), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(
            F.count_if(F.col(label) == 0).cast("double").alias("zeros"),
            F.count_if(F.col(label) == 1).cast("double").alias("ones"),
        )
    )
    totals = counts.groupBy("feature").agg(F.sum("zeros").alias("zeros_all"), F.sum("ones").alias("ones_all"))
    return _best(_sides(counts, cut(totals), partitions))


def _sides(counts: DataFrame, groups: DataFrame, partitions: int | None) -> DataFrame:
    """``feature``, ``threshold`` and both classes' counts on either side (``zl``, ``ol``, ``zr``, ``or``) for all
    thresholds between neighbouring values of a ``feature`` in ``counts``.

    ``groups`` has one row per feature: its ``zeros_all`` and ``ones_all``, and, where ``counts`` has a part of its
    values only, the ``zeros_before`` and ``ones_before`` them.
    """
    # Stored, because the rows are read twice and must keep their ranges.
    values = cut(by_range(counts, ["feature", "value"], partitions))
    by_part = Window.partitionBy("feature").orderBy("part")
    lower = by_part.rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        values.groupBy("feature", "part")
        .agg(
            F.sum("zeros").alias("zeros"),
            F.sum("ones").alias("ones"),
            F.min("value").alias("first_value"),
        )
        .select(
            "feature",
            "part",
            F.coalesce(F.sum("zeros").over(lower), F.lit(0.0)).alias("zeros_lower"),
            F.coalesce(F.sum("ones").over(lower), F.lit(0.0)).alias("ones_lower"),
            F.lead("first_value").over(by_part).alias("value_above"),
        )
        .join(groups, "feature")
    )
    if "zeros_before" in groups.columns:
        parts = parts.withColumns(
            {f"{c}_lower": F.col(f"{c}_lower") + F.col(f"{c}_before") for c in ("zeros", "ones")}
        )
    in_part = Window.partitionBy("feature", "part").orderBy("value")
    upto = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Broadcast: ranges are contiguous in (feature, value), so there are fewer than
    # partitions + features rows, whatever the data.
    candidates = (
        values.select(
            "feature",
            "part",
            "value",
            F.sum("zeros").over(upto).alias("zeros_part"),
            F.sum("ones").over(upto).alias("ones_part"),
            F.lead("value").over(in_part).alias("next_value"),
        )
        .join(F.broadcast(parts), ["feature", "part"])
        .withColumn("next_value", F.coalesce("next_value", "value_above"))
        .where(F.col("next_value").isNotNull())
    )
    zl = F.col("zeros_lower") + F.col("zeros_part")
    ol = F.col("ones_lower") + F.col("ones_part")
    return candidates.select(
        "feature",
        ((F.col("value") + F.col("next_value")) / 2).alias("threshold"),
        zl.alias("zl"),
        ol.alias("ol"),
        (F.col("zeros_all") - zl).alias("zr"),
        (F.col("ones_all") - ol).alias("or"),
    )


def _gain(zl: float, ol: float, zeros: float, ones: float) -> float:
    """The gain of a split with these counts on its left; 0 with nothing on a side."""

    def impure(a: float, b: float) -> float:
        return (a + b) * (1 - (a / (a + b)) ** 2 - (b / (a + b)) ** 2) if a + b else 0.0

    return (impure(zeros, ones) - impure(zl, ol) - impure(zeros - zl, ones - ol)) / (zeros + ones)


def pruned_gini_splits(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    bins: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """The rows of :func:`gini_splits`, with only some values counted one by one.

    Quantiles cut each feature into bins, whose classes are counted in one aggregation of fixed size. The gain
    is convex in the counts on the left, so inside a bin it is at most the largest of four: with none, all
    zeros, all ones, or all of the bin added to what is below it. Bins that cannot reach the best gain at
    the border of any bin are done with. Only the values of the others are counted, ranged and cumulated; no
    row is shuffled for the rest, however many distinct values there are.
    """
    known = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_label"), *[F.col(f).cast("double").alias(f) for f in features]
    )
    known = cut(known)
    shares = [i / bins for i in range(1, bins)]
    row = known.agg(*[F.percentile_approx(f, shares, 10 * bins).alias(f) for f in features]).first()
    edges = {f: sorted(set(row[f] or [])) for f in features}

    def bin_of(feature: str) -> Column:
        """How many edges are below the value."""
        below = F.lit(0)
        for edge in edges[feature]:
            below = below + F.when(F.col(feature) > edge, 1).otherwise(0)
        return F.when(F.col(feature).isNotNull(), below)

    def long(rows: DataFrame, wanted: dict[str, list[int]] | None = None) -> DataFrame:
        structs = [
            F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin"), F.col(f).alias("value"))
            for f in features
            if wanted is None or wanted[f]
        ]
        kept = F.array(*structs)
        if wanted is not None:
            pairs = [F.lit(f"{f}/{b}") for f, bs in wanted.items() for b in bs]
            kept = F.filter(kept, lambda x: F.concat_ws("/", x["feature"], x["bin"]).isin(*pairs))
        return rows.select("_label", F.inline(kept)).where(F.col("bin").isNotNull())

    classes = [
        F.count_if(F.col("_label") == 0).cast("double").alias("zeros"),
        F.count_if(F.col("_label") == 1).cast("double").alias("ones"),
    ]
    counted = (
        long(known)
        .groupBy("feature", "bin")
        .agg(*classes, F.min("value").alias("low"), F.max("value").alias("high"))
        .orderBy("feature", "bin")
        .collect()  # at most bins rows per feature
    )
    groups, borders, wanted = [], [], {f: [] for f in features}
    for feature in features:
        own = [r for r in counted if r["feature"] == feature]
        zeros, ones = (sum(r[c] for r in own) for c in ("zeros", "ones"))
        if not zeros + ones:
            continue
        starts, zl, ol = [], 0.0, 0.0
        for r, above in zip(own, [*own[1:], None]):
            starts.append((zl, ol))
            zl, ol = zl + r["zeros"], ol + r["ones"]
            if above is not None:
                borders.append((feature, (r["high"] + above["low"]) / 2, zl, ol, zeros - zl, ones - ol))
        best = max((_gain(z, o, zeros, ones) for f, _, z, o, _, _ in borders if f == feature), default=0.0)
        for r, (zl, ol) in zip(own, starts):
            corners = [(zl + a, ol + b) for a in (0.0, r["zeros"]) for b in (0.0, r["ones"])]
            # Gains are compared to twelve places, so equal ones within that are kept.
            if r["low"] < r["high"] and max(_gain(*c, zeros, ones) for c in corners) >= best - 1e-11:
                wanted[feature].append(r["bin"])
                groups.append((f"{feature}/{r['bin']}", feature, zeros, ones, zl, ol))
    columns = "feature string, threshold double, zl double, ol double, zr double, or double"
    sides = df.sparkSession.createDataFrame(borders, columns)
    if groups:
        names = "feature string, name string, zeros_all double, ones_all double, zeros_before double, ones_before double"
        groups = df.sparkSession.createDataFrame(groups, names)
        counts = cut(
            long(known, wanted)
            .groupBy(F.concat_ws("/", "feature", "bin").alias("feature"), "value")
            .agg(*classes)
        )
        inside = _sides(counts, groups.drop("name"), partitions).join(groups.select("feature", "name"), "feature")
        sides = sides.union(inside.select("name", "threshold", "zl", "ol", "zr", "or"))
    return _best(sides)


def binned_gini_splits(
    df: DataFrame, features: Sequence[str], label: str = "label", bins: int = 32
) -> DataFrame:
    """The best split of every feature among at most ``bins - 1`` thresholds, as a tree takes it.

    Thresholds come from approximate quantiles, in one pass; each lies midway between the values
    around it if a feature has no more than ``bins`` of them. One aggregation of fixed size then
    counts both classes on the left of every threshold; rows are neither multiplied nor shuffled.
    """
    shares = [i / bins for i in range(bins + 1)]
    known = df.where(F.col(label).isNotNull())
    # Up to ``bins`` distinct values are exact; more are replaced by quantiles.
    found = known.agg(
        *[F.percentile_approx(f, shares, 10_000).alias(f) for f in features],
        *[F.approx_count_distinct(f, 0.01).alias(f"distinct_{f}") for f in features],
    ).first()
    few = [f for f in features if found[f"distinct_{f}"] <= 2 * bins]
    values = {f: sorted(set(found[f] or [])) for f in features}
    if few:
        exact = known.agg(*[F.collect_set(f).alias(f) for f in few]).first()
        values |= {f: sorted(exact[f]) for f in few if len(exact[f]) <= bins}
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f, v in values.items()}
    zero, one = F.col(label) == 0, F.col(label) == 1
    counts = [
        F.struct(
            F.lit(f).alias("feature"),
            F.lit(float(c)).alias("threshold"),
            *[F.count_if(k & (F.col(f) <= c)).cast("double").alias(n) for k, n in ((zero, "zl"), (one, "ol"))],
            *[F.count_if(k & (F.col(f) > c)).cast("double").alias(n) for k, n in ((zero, "zr"), (one, "or"))],
        )
        for f in features
        for c in cuts[f]
    ]
    if not counts:
        nothing = "feature string, threshold double, zl double, ol double, zr double, or double"
        return _best(df.sparkSession.createDataFrame([], nothing))
    return _best(known.agg(F.array(*counts).alias("all")).select(F.inline("all")))


def _best(sides: DataFrame) -> DataFrame:
    """The row of the highest gain per feature, from both classes' counts on either side."""
    zl, ol, zr, or_ = (F.col(c) for c in ("zl", "ol", "zr", "or"))
    n = zl + ol + zr + or_
    gain = (
        _impurity(zl + zr, ol + or_)
        - (zl + ol) / n * _impurity(zl, ol)
        - (zr + or_) / n * _impurity(zr, or_)
    )
    # Highest gain wins, the lower threshold on a tie.
    split = F.struct(
        F.round(gain, 12).alias("gain"),
        (-F.col("threshold")).alias("minus_threshold"),
        (zl + ol).cast("bigint").alias("n_left"),
        (zr + or_).cast("bigint").alias("n_right"),
    )
    return (
        sides.groupBy("feature")
        .agg(F.max(split).alias("best"))
        .select(
            "feature",
            (-F.col("best.minus_threshold")).alias("threshold"),
            F.col("best.gain").alias("gain"),
            F.col("best.n_left").alias("n_left"),
            F.col("best.n_right").alias("n_right"),
        )
    )
