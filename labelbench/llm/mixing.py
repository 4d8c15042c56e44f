"""Mixing sources to target weights by weighted fair queueing.

Every copy of a document gets a virtual finish time: the words of its source up to its end, in a
shuffled order, divided by the source's weight. All copies are sorted by finish time over the whole
corpus and the queue is cut where the words so far reach the budget. A source that is read
``max_repeats`` times is exhausted, and the others go on sharing by weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelbench.llm.running import running_sum, word_count
from labelbench.shared import cut

ROWS_PER_RANGE = 50_000
UNIT = ["doc_id", "size", "text_hash"]


def source_targets(sizes: DataFrame, cycle: Sequence[float], max_repeats: int) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``weight``, ``source_rank``, ``target``,
    ``level``.

    Sources by code point, null last, take the weights of ``cycle`` in turn. The budget is the size
    of everything. ``level`` is the virtual time at which it is used up: the largest (budget - caps
    of the sources below) / (weights from here on), over sources by cap / weight that outlast it.
    """
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "source_rank")
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    above = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    step = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum(
        "weight"
    ).over(above)
    return (
        sizes.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
        .withColumn("source_rank", F.row_number().over(ranked) - 1)
        .withColumn("weight", F.get(weights, F.col("source_rank") % len(cycle)))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("step", step)
        .withColumn("level", F.max(F.when(F.col("ratio") >= F.col("step"), F.col("step"))).over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .select("source", "source_size", "weight", "source_rank", "target", "level")
    )


def _last_taken(queue: DataFrame, budget: int):
    """The (finish, rank) of the last copy that fits the budget; null when there is none.

    One row per range tells which range the budget ends in; only that range is cumulated by row.
    """
    ranges = max(1, queue.count() // ROWS_PER_RANGE)
    ordered = cut(
        queue.repartitionByRange(ranges, "finish", "source_rank").withColumn(
            "part", F.spark_partition_id()
        )
    )
    totals = ordered.groupBy("part").agg(F.sum("words").alias("total"))
    through = totals.withColumn("through", F.sum("total").over(Window.orderBy("part")))
    full = through.where(F.col("through") > budget).orderBy("part").first()
    if full is None:
        kept = ordered
    else:
        upto = F.sum("words").over(
            Window.partitionBy("part")
            .orderBy("finish", "source_rank")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        left = budget - (full["through"] - full["total"])
        kept = (
            ordered.where(F.col("part") == full["part"])
            .withColumn("upto", upto)
            .where(F.col("upto") <= left)
            .drop("upto")
            .union(ordered.where(F.col("part") < full["part"]))
        )
    return kept.agg(F.max(F.struct("finish", "source_rank")).alias("last")).first()["last"]


def _each_row(units: DataFrame) -> DataFrame:
    """``units`` once for each of its ``rows``, numbered from 1 in ``row``. In two steps, so that no
    array is longer than ``ROWS_PER_RANGE``, however many rows agree in everything."""
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, F.lit(ROWS_PER_RANGE)))
    last = F.least(F.col("rows"), F.col("_first") + ROWS_PER_RANGE)
    return (
        units.withColumn("_first", first)
        .withColumn("row", F.explode(F.sequence(F.col("_first") + 1, last)))
        .drop("_first")
    )


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words (0 for null), and ``text_hash``."""
    return docs.withColumn("size", word_count("text")).withColumn("text_hash", F.xxhash64("text"))


def shuffled(seed: int):
    """Where a unit is in the order of its source: by this hash, then by the unit's values."""
    return F.xxhash64(F.lit(seed), *UNIT)


def fair_queue(
    docs: DataFrame, cycle: Sequence[float] = (1, 2, 3), max_repeats: int = 3, seed: int = 1
) -> DataFrame:
    """What the mix takes of each row of ``docs``: ``doc_id``, ``source``, ``size``, ``text_hash``,
    ``row``, ``rows``, ``source_size``, ``target``, ``copies``.

    ``docs`` needs ``doc_id``, ``source`` and ``text``. Size is the number of words, 0 for null.
    Rows that agree in doc_id, source, size and the text's hash are a unit: they stand one behind the
    other in the shuffled order, ``row`` of ``rows`` rows, but are taken one by one. Documents
    without words are never taken. A null source is a source of its own, a null doc_id an ordinary
    value. No rows give no rows. The shuffle depends on the values and the seed alone, so reruns
    agree.
    """
    units = cut(
        measured(docs.select("doc_id", "source", "text"))
        .groupBy("source", *UNIT)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("words", F.col("size") * F.col("rows"))
        .withColumn("order", shuffled(seed))
    )
    sources = cut(source_targets(units, cycle, max_repeats))
    # A few numbers per source: stored, so its true size decides whether it is broadcast.
    names = sources.withColumnRenamed("source", "name")
    ranked = units.join(names, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    timed = running_sum(cut(ranked), ["source_rank"], ["order", *UNIT], "words", "upto")
    each = cut(
        _each_row(timed).withColumn("upto", F.col("upto") - F.col("words") + F.col("row") * F.col("size"))
    )
    budget, level = sources.agg(F.sum("source_size"), F.max("level")).first()

    def finish(turn):
        return (turn * F.col("source_size") + F.col("upto")) / F.col("weight")

    def starts_in_time(turn):
        return finish(turn) - F.col("size") / F.col("weight") < F.lit(level)

    turns = range(max_repeats)
    queue = (
        each.where("size > 0")
        .withColumn("turn", F.explode(F.array(*[F.lit(t) for t in turns])))
        .where(starts_in_time(F.col("turn")))
        .select(finish(F.col("turn")).alias("finish"), "source_rank", F.col("size").alias("words"))
    )
    last = _last_taken(queue, budget or 0)
    if last is None:
        copies = F.lit(0)
    else:
        copies = sum(
            F.when(
                starts_in_time(F.lit(t))
                & (
                    (finish(F.lit(t)) < last["finish"])
                    | ((finish(F.lit(t)) == last["finish"]) & (F.col("source_rank") <= last["source_rank"]))
                ),
                1,
            ).otherwise(0)
            for t in turns
        )
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return each.select("source", *UNIT, "row", "rows", "source_size", "target", copies.alias("copies"))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``."""
    return fair_queue(docs, **options).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, with the same columns.

    The rows of a unit mostly have as many copies each. Where the queue ends inside a unit, its rows
    are numbered by their other columns, so that as many rows are taken as the queue says.
    """
    queue = cut(fair_queue(docs, **options))
    own = ["source", *UNIT]
    units = queue.groupBy(*own).agg(F.min("copies").alias("_least"), F.max("copies").alias("_most"))
    units = units.where("_most > 0").select(
        *[F.col(c).alias(f"_{c}") for c in own], "_least", "_most"
    )
    sized = docs.withColumns({"_words": word_count("text"), "_hash": F.xxhash64("text")})

    def same(left: dict[str, str]):
        return [F.col(a).eqNullSafe(F.col(b)) for a, b in left.items()]

    keys = {"doc_id": "_doc_id", "source": "_source", "_words": "_size", "_hash": "_text_hash"}
    joined = sized.join(units, reduce(and_, same(keys)))
    rows = joined.where("_least = _most").select(*docs.columns, F.col("_most").alias("_copies"))
    if not units.where("_least < _most").isEmpty():
        sortable = [
            f.name
            for f in docs.schema.fields
            if not f.dataType.simpleString().startswith(("map", "variant"))
        ]
        ended = cut(
            joined.where("_least < _most")
            .withColumn("_unit", F.to_json(F.struct("_doc_id", "_source", "_size", "_text_hash")))
            .withColumn("_order", F.xxhash64(*sortable))
            .withColumn("_one", F.lit(1).cast("bigint"))
        )
        numbered = running_sum(ended, ["_unit"], ["_order"], "_one", "_row")
        places = queue.select(
            *[F.col(c).alias(f"_q_{c}") for c in own], F.col("row").alias("_q_row"), F.col("copies").alias("_copies")
        )
        keys = {f"_{c}": f"_q_{c}" for c in own} | {"_row": "_q_row"}
        rows = rows.union(numbered.join(places, reduce(and_, same(keys))).select(*docs.columns, "_copies"))
    taken = rows.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return taken.select(*docs.columns)
