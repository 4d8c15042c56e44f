"""A prefix trie of conversations, found by blocks of turns.

Conversations are cut into blocks of a fixed number of turns. A digest of all turns before a block
names the node where the block begins; conversations with the same digest and the same block share
all nodes in it. So first whole blocks are grouped, and each different one is kept once, with the
number of its conversations. Only where blocks with the same beginning differ are they taken apart
into turns, to find the turn at which the siblings part.

Digests of sequences are two 64-bit exclusive ors of hashes of turns and their places, so those of
prefixes come from running exclusive ors, inside conversations of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelbench.llm.batches import column
from labelbench.shared import cut

BLOCK_TURNS = 4
BLOCKS_TOGETHER = 1024  # blocks of a conversation that one window holds
TURNS_PER_RANGE = 200_000
CYCLE, MOST_HEAD = 100, 5
NODE = ["depth", "a", "b"]


def _xor(x: str | Column, y: str | Column) -> Column:
    x, y = (F.col(v) if isinstance(v, str) else v for v in (x, y))
    return x.bitwiseXOR(y)


def placed_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos``, ``x``, ``y``, ``chars`` of every turn: its place, from 1 on, two hashes of
    role and text, and the code points of the text.

    Turns are in order of ``turn``, null first; those that tie are in order of their hashes. Null
    roles and texts count as empty. Rows without a conv_id belong to no conversation and are left out.
    Places come from ranges of all turns and the counts of earlier ranges, so a conversation may be of
    any length.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("x"),
        F.xxhash64(F.lit(2), role, text).alias("y"),
        F.char_length(text).cast("long").alias("chars"),
    )
    turns = cut(turns)
    ranges = max(1, turns.count() // TURNS_PER_RANGE)
    order = [F.col("turn").asc_nulls_first(), "x", "y"]
    ordered = cut(
        turns.repartitionByRange(ranges, "conv_id", *order).withColumn("part", F.spark_partition_id())
    )
    counts = ordered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("own"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "conv_id", "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    return (
        ordered.withColumn("inside", inside)
        .join(offsets, ["conv_id", "part"])
        .select("conv_id", (F.col("before") + F.col("inside")).alias("pos"), "x", "y", "chars")
    )


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation c anew: (its turns, all ``conv_id``).

    It begins with the first h turns of c - c % 100, h being crc32(c as text) % 6, or with all of them
    if there are fewer; its own turns after its first h follow. ``placed`` is stored.
    """
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)
    convs = cut(
        convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % CYCLE).withColumn("h", head)
    )
    is_base = F.col("conv_id") % CYCLE == 0
    base = convs.where(is_base).select("base", F.col("own").alias("base_own"))
    taken = F.least("h", F.coalesce("base_own", F.lit(0)))
    convs = cut(convs.join(base, "base", "left").withColumn("taken", taken))
    heads = placed.where(is_base & (F.col("pos") <= MOST_HEAD)).withColumnRenamed("conv_id", "base")
    begun = (
        convs.select("conv_id", "base", "taken").join(heads, "base").where(F.col("pos") <= F.col("taken"))
    )
    after = placed.join(convs.select("conv_id", "h", "taken"), "conv_id").where(F.col("pos") > F.col("h"))
    after = after.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "x", "y", "chars"]
    return begun.select(*columns).union(after.select(*columns)), convs.select("conv_id")


def _blocks(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``block``, ``a``, ``b``, ``before``: what is before each block, as digest and code
    points, and ``in_a``, ``in_b``, ``turns``, ``chars`` of the block itself."""
    blocks = cut(
        turns.groupBy("conv_id", "block").agg(
            F.bit_xor("x").alias("in_a"),
            F.bit_xor("y").alias("in_b"),
            F.count(F.lit(1)).alias("turns"),
            F.sum("chars").alias("chars"),
        )
    ).withColumn("run", F.floor(F.col("block") / BLOCKS_TOGETHER))

    def before(window, names: list[str]) -> list[Column]:
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        sums = [F.bit_xor(names[0]), F.bit_xor(names[1]), F.sum(names[2])]
        return [F.coalesce(s.over(window), F.lit(0).cast("long")) for s in sums]

    inner = before(Window.partitionBy("conv_id", "run").orderBy("block"), ["in_a", "in_b", "chars"])
    runs = blocks.groupBy("conv_id", "run").agg(
        F.bit_xor("in_a").alias("a"), F.bit_xor("in_b").alias("b"), F.sum("chars").alias("c")
    )
    outer = before(Window.partitionBy("conv_id").orderBy("run"), ["a", "b", "c"])
    runs = runs.select("conv_id", "run", *[c.alias(f"run_{n}") for n, c in zip("abc", outer)])
    return (
        blocks.withColumns(dict(zip(("a", "b", "before"), inner)))
        .join(runs, ["conv_id", "run"])
        .withColumns(
            {
                "a": _xor("a", "run_a"),
                "b": _xor("b", "run_b"),
                "before": F.col("before") + F.col("run_c"),
            }
        )
        .drop("run", "run_a", "run_b", "run_c")
    )


CONTENT = ["block", "a", "b", "in_a", "in_b", "turns"]


def _first_turns(turns: DataFrame, blocks: DataFrame) -> DataFrame:
    """The turns of each different block, from the smallest of its conversations: ``conv_id``,
    ``block``, ``alone`` and the node that each turn leads to: ``depth``, ``a``, ``b``, its parent's
    ``up_a``, ``up_b``, its ``chars`` and those ``before`` it. ``alone`` blocks have no siblings."""
    contents = blocks.groupBy(*CONTENT).agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("before"))
    contents = cut(contents)
    # The only block behind its beginning is named by its smallest conversation.
    alone = (
        contents.groupBy("block", "a", "b")
        .agg(F.count(F.lit(1)).alias("siblings"), F.min("conv_id").alias("conv_id"))
        .where("siblings = 1")
        .select("conv_id", "block", F.lit(True).alias("alone"))
    )
    contents = contents.join(alone, ["conv_id", "block"], "left")
    here = Window.partitionBy("conv_id", "block").orderBy("pos")
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    return (
        turns.join(contents.select("conv_id", "block", "a", "b", "before", "alone"), ["conv_id", "block"])
        .withColumns(
            {
                "a": _xor("a", F.bit_xor("x").over(upto)),
                "b": _xor("b", F.bit_xor("y").over(upto)),
                "before": F.col("before") + F.sum("chars").over(upto) - F.col("chars"),
            }
        )
        .select(
            "conv_id",
            "block",
            F.coalesce("alone", F.lit(False)).alias("alone"),
            F.col("pos").alias("depth"),
            "a",
            "b",
            _xor("a", "x").alias("up_a"),
            _xor("b", "y").alias("up_b"),
            "chars",
            "before",
        )
    )


def _nodes(firsts: DataFrame, blocks: DataFrame, sums: list[str]) -> DataFrame:
    """One row per node: ``depth``, ``a``, ``b``, ``up_a``, ``up_b``, ``chars``, ``before``, its smallest
    ``conv_id``, and the ``sums`` over its conversations. Blocks are added up first; those without
    siblings have their nodes to themselves, the others are taken apart into turns."""
    weights = blocks.groupBy(*CONTENT).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(s).alias(s) for s in sums]
    )
    turns = cut(firsts.join(weights.select("conv_id", "block", *sums), ["conv_id", "block"]))
    same = ["up_a", "up_b", "chars", "before"]
    columns = [*NODE, *same, "conv_id", *sums]
    parted = (
        turns.where("NOT alone")
        .groupBy(*NODE)
        .agg(
            *[F.min(s).alias(s) for s in same],
            F.min("conv_id").alias("conv_id"),
            *[F.sum(s).alias(s) for s in sums],
        )
    )
    return turns.where("alone").select(*columns).union(parted.select(*columns))


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``depth``, ``a``, ``b``, ``ends_sha256``: of the conv_ids that end at a node, in order.

    The ids of a node pass through one hash in turn, so that of a node where many end is made in one
    task, from sorted rows as they stream by; nothing is held but the state of the hash.
    """
    schema = pa.schema(
        [("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            keys = np.column_stack([column(batch, c).to_numpy() for c in NODE])
            new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
            done = []
            ids = column(batch, "conv_id").to_pylist()
            starts = np.flatnonzero(new).tolist()
            for start, end in zip(starts, [*starts[1:], len(ids)]):
                text = ",".join(map(str, ids[start:end])).encode()
                key = tuple(keys[start].tolist())
                if key == node:
                    state.update(b"," + text)
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, sha256(text)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(schema.names, (*node, state.hexdigest())))], schema=schema
            )

    return (
        ends.repartition(*NODE)
        .sortWithinPartitions(*NODE, "conv_id")
        .mapInArrow(run, "depth long, a long, b long, ends_sha256 string")
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct sequence of the first d turns of any conversation, the empty one included:
    ``conv_id`` (the smallest that begins so), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` has ``conv_id``, ``pos`` (1 and on without gaps), ``x``, ``y`` and ``chars`` as
    :func:`placed_turns` gives them; ``convs`` has all ``conv_id``, also of those without turns.
    ``n_leaves`` are the nodes without children in the subtree; ``saved_tokens`` the code points that
    its conversations share, those of each node's last turn for all its conversations but one;
    ``ends_sha256`` is of the conv_ids that end here, in order and joined by commas. Subtrees include
    their top. No conversations give no rows.

    Nothing goes from node to node: sums over subtrees are sums over conversations. Each leaf, and each
    node's own text, is booked to the smallest conversation there; these bookings are added up over the
    conversations of each node, with the parts before the node taken off.
    """
    spark = turns.sparkSession
    tagged = turns.select(
        "conv_id",
        "pos",
        F.floor((F.col("pos") - 1) / block_turns).alias("block"),
        F.xxhash64("x", "pos").alias("x"),
        F.xxhash64("y", "pos").alias("y"),
        "chars",
    )
    tagged = cut(tagged)
    blocks = cut(_blocks(tagged))
    firsts = cut(_first_turns(tagged, blocks))
    nodes = cut(_nodes(firsts, blocks.withColumn("n_convs", F.lit(1)), ["n_convs"]))
    children = cut(
        nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    leaves = nodes.join(children, NODE, "left_anti").select("conv_id", F.lit(1).alias("leaves"))
    booked = nodes.groupBy("conv_id").agg(F.sum("chars").alias("booked"))
    zero = F.lit(0).cast("long")
    whole = (
        blocks.groupBy("conv_id")
        .agg(
            F.sum("turns").alias("depth"),
            F.bit_xor("in_a").alias("a"),
            F.bit_xor("in_b").alias("b"),
            F.sum("chars").alias("total"),
        )
        .join(booked, "conv_id", "left")
        .join(leaves, "conv_id", "left")
        .withColumns({c: F.coalesce(c, zero) for c in ("booked", "leaves")})
    )
    whole = cut(convs.distinct().join(whole, "conv_id", "left").na.fill(0))
    sums = ["n_convs", "n_leaves", "total", "booked"]
    weights = whole.select(
        "conv_id", F.lit(1).alias("n_convs"), F.col("leaves").alias("n_leaves"), "total", "booked"
    )
    weighed = blocks.join(weights, "conv_id")
    nodes = cut(_nodes(firsts, weighed, sums))
    smallest = whole.select(
        "conv_id", F.col("total").alias("own_total"), F.col("booked").alias("own_booked")
    )
    saved = (
        F.col("total")
        - F.col("n_convs") * F.col("before")
        - (F.col("booked") - F.col("own_booked") + F.col("own_total") - F.col("before"))
    )
    # The empty sequence: a few numbers of all conversations.
    top = whole.agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum("leaves").alias("leaves"),
        (F.sum("total") - F.sum("booked")).alias("saved"),
    ).first()
    root = spark.range(1 if top["n_convs"] else 0).select(
        F.lit(0).cast("long").alias("depth"),
        zero.alias("a"),
        zero.alias("b"),
        F.lit(top["conv_id"]).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(top["n_convs"]).cast("long").alias("n_convs"),
        F.lit(max(1, top["leaves"] or 0)).cast("long").alias("n_leaves"),
        F.lit(top["saved"] or 0).cast("long").alias("saved_tokens"),
    )
    parents = nodes.select(
        F.col("depth").alias("up"),
        F.col("a").alias("of_a"),
        F.col("b").alias("of_b"),
        F.col("conv_id").alias("up_conv"),
    )
    is_parent = (
        (F.col("depth") - 1 == F.col("up")) & (F.col("up_a") == F.col("of_a")) & (F.col("up_b") == F.col("of_b"))
    )
    parent = F.when(F.col("depth") == 1, F.lit(top["conv_id"])).otherwise(F.col("up_conv"))
    below = (
        nodes.join(smallest, "conv_id")
        .join(parents, is_parent, "left")
        .select(
            *NODE,
            "conv_id",
            parent.cast("long").alias("parent_conv_id"),
            "n_convs",
            "n_leaves",
            saved.alias("saved_tokens"),
        )
    )
    ends = _ends_digests(whole.select(*NODE, "conv_id"))
    return (
        root.union(below)
        .join(children, NODE, "left")
        .join(ends, NODE, "left")
        .select(
            "conv_id",
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
