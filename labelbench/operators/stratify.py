"""Splits that keep the share of every class exactly.

A split by hash gives each class about its share, which for a rare class may be far off. Here each class is
cut at its own k-th smallest hash. That is found without a sort: counts of the first bits of the hashes tell
which bin the k-th is in, counts of the next bits inside this bin go on from there, until it is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelbench.shared import cut

# Hashes are numbers of 60 bits, found in four rounds of 15.
DIGITS, ROUND_BITS, ROUNDS = 15, 15, 4


def position_of(key: str | Column) -> Column:
    """A number below 2**60 from the key alone: the first hexadecimal digits of its digest."""
    key = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(key.cast("string")), 1, DIGITS), 16, 10).cast("bigint")


def class_cuts(df: DataFrame, key: str, by: str, percent: int = 80) -> DataFrame:
    """``class``, ``n``, ``wanted``, ``cut``: of the class's n rows the ``wanted`` with the smallest positions
    have one of at most ``cut``. ``wanted`` is percent of n, rounded half up.

    Rows with the same key are never parted: where the k-th row is one of several, all of them go, or none
    if that were more than ``wanted``. A null class is a class, a null key has no position and is not counted.
    Each round is one aggregation to at most 2**15 counts per class; only keys and classes are read.
    """
    rows = cut(
        df.where(F.col(key).isNotNull()).select(F.col(by).alias("class"), position_of(key).alias("position"))
    )
    wanted = F.floor((F.col("n") * percent + 50) / 100)
    state = cut(
        rows.groupBy("class")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "class",
            "n",
            wanted.alias("wanted"),
            wanted.alias("left"),  # of the rows inside the bin found so far
            F.lit(0).cast("bigint").alias("bin"),
            F.lit(-1).cast("bigint").alias("below"),  # the last position before the bin
        )
    )
    for number in range(1, ROUNDS + 1):
        shift = ROUND_BITS * (ROUNDS - number)
        known = state.select(F.col("class").alias("of"), "left", F.col("bin").alias("inside"))
        open_ = rows.join(known, F.col("class").eqNullSafe(F.col("of"))).where(
            F.shiftright("position", shift + ROUND_BITS) == F.col("inside")
        )
        counts = open_.groupBy("class", "left", F.shiftright("position", shift).alias("bin")).agg(
            F.count(F.lit(1)).alias("own")
        )
        upto = F.sum("own").over(Window.partitionBy("class").orderBy("bin"))
        # The last bin that does not go beyond what is wanted ends the sure part; the next one is open.
        counts = counts.withColumn("upto", upto).withColumn("fits", F.col("upto") <= F.col("left"))
        found = counts.groupBy(F.col("class").alias("of")).agg(
            F.max(F.when(F.col("fits"), F.col("upto"))).alias("taken"),
            F.min(F.when(~F.col("fits"), F.col("bin"))).alias("next"),
            F.max("bin").alias("last"),
        )
        # Without an open bin everything fits: the next one is behind all that there are.
        following = F.coalesce("next", F.col("last") + 1, F.shiftleft("bin", ROUND_BITS))
        state = cut(
            state.join(found, F.col("class").eqNullSafe(F.col("of")), "left").select(
                "class",
                "n",
                "wanted",
                (F.col("left") - F.coalesce("taken", F.lit(0))).alias("left"),
                following.alias("bin"),
                (F.shiftleft(following, shift) - 1).alias("below"),
            )
        )
    return state.select("class", "n", "wanted", F.col("below").alias("cut"))


def tag_class_split(df: DataFrame, key: str, by: str, percent: int = 80) -> DataFrame:
    """``df`` with ``split`` = train | test: of every class exactly ``percent`` of its rows are train rows.

    The counts are exact where keys are distinct (see :func:`class_cuts`). The same rows give the same
    split in any layout. Rows with a null key are test rows.
    """
    cuts = class_cuts(df, key, by, percent).select(F.col("class").alias("_class"), F.col("cut").alias("_cut"))
    tagged = df.join(cuts, F.col(by).eqNullSafe(F.col("_class")), "left")
    side = F.when(position_of(key) <= F.col("_cut"), "train").otherwise("test")
    return tagged.withColumn("split", side).drop("_class", "_cut")
