"""Relative importance of inputs by sensitivity analysis.

One input at a time moves over its range while the others stay at their means; how far a model's
response moves tells how much it depends on that input. The design is a few rows, so any model scores
it in one scan, and nothing about the model needs to be known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: into so many levels an input's range is cut.
LEVELS = 6


def probe_rows(df: DataFrame, inputs: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """``input``, ``level`` (0 to levels - 1), and the ``inputs`` as columns: ``input`` at this level of
    its range, the others at their means.

    One aggregation of ``df`` gives everything. Nulls and NaN are left out of means and ranges; an input
    without any value is null in every row.
    """
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in inputs}
    stats = df.agg(
        *[f(clean[c]).alias(f"{name}_{c}") for c in inputs for name, f in (("min", F.min), ("max", F.max), ("avg", F.avg))]
    )

    def at(name: str, level: int):
        low, high = F.col(f"min_{name}"), F.col(f"max_{name}")
        return low + (high - low) * level / max(1, levels - 1)

    rows = [
        F.struct(
            F.lit(moved).alias("input"),
            F.lit(level).alias("level"),
            *[(at(c, level) if c == moved else F.col(f"avg_{c}")).alias(c) for c in inputs],
        )
        for moved in inputs
        for level in range(levels)
    ]
    return stats.select(F.inline(F.array(*rows)))


def response_ranges(scored: DataFrame, response: str = "prediction") -> DataFrame:
    """``input``, ``low``, ``high``, ``range``, ``gradient``, ``variance``, ``importance`` of scored probe rows.

    ``range`` is the largest less the smallest response, ``gradient`` the mean step between neighbouring
    levels, ``variance`` the sample variance over the levels, and ``importance`` the input's share of
    all ranges, null when nothing moves the response.
    """
    value = F.col(response).cast("double")
    before = F.lag(value).over(Window.partitionBy("input").orderBy("level"))
    moved = (
        scored.select("input", value.alias("value"), F.abs(value - before).alias("step"))
        .groupBy("input")
        .agg(
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            (F.max("value") - F.min("value")).alias("range"),
            F.avg("step").alias("gradient"),
            F.var_samp("value").alias("variance"),
        )
    )
    # One row per input from here on.
    return moved.withColumn("importance", F.try_divide("range", F.sum("range").over(Window.partitionBy())))
