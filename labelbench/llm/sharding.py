"""Sharding with near-equal bytes by Karmarkar-Karp differencing of indivisible groups.

Equal texts form a group that stays together. A partial partition is a tuple of shard sums with the
groups behind them. The two partitions of largest spread are combined again and again, the largest
sum of one with the smallest of the other, until one is left. Groups are dealt to cells of bounded
size by a hash; every cell is differenced in its own task, and the cells' partitions, which are then
just tuples of sums, are differenced in turn by the same rule until one is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelbench.llm.running import running_sum
from labelbench.shared import cut

CELL = 4096


def differences(partitions: Sequence[Sequence[int]]) -> tuple[np.ndarray, list[int]]:
    """Combine partial partitions: (for each, the shard of each of its places; the shard sums).

    Sums come out ascending. Largest spread first; ties by position.
    """
    width = len(partitions[0])
    # node: sums ascending; parts: (index or node, place of each shard in it)
    heap = []
    for i, sums in enumerate(partitions):
        order = sorted(range(width), key=sums.__getitem__)
        ordered = [sums[j] for j in order]
        heap.append((ordered[0] - ordered[-1], i, ordered, (i, order)))
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, a, tree_a = heapq.heappop(heap)
        _, _, b, tree_b = heapq.heappop(heap)
        sums = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(width), key=sums.__getitem__)
        ordered = [sums[j] for j in order]
        tree = (tree_a, tree_b, order)
        heapq.heappush(heap, (ordered[0] - ordered[-1], tie, ordered, tree))
        tie += 1
    _, _, sums, tree = heap[0]
    shards = np.empty((len(partitions), width), np.int32)
    stack = [(tree, list(range(width)))]
    while stack:
        node, names = stack.pop()  # names: the shard of each place of the node
        if len(node) == 2:
            index, order = node
            shards[index, order] = names
            continue
        first, second, order = node
        back = [0] * width
        for place, shard in zip(order, names):
            back[place] = shard
        stack.append((first, back))
        stack.append((second, back[::-1]))
    return shards, sums


def _cell_of_groups(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "group"], kind="stable", ignore_index=True)
        start = [[0] * (width - 1) + [int(b)] for b in pdf["bytes"]]
        shards, _ = differences(start)
        return pd.DataFrame(
            {"group": pdf["group"], "bytes": pdf["bytes"], "cell": pdf["cell"], "place": shards[:, -1]}
        )

    return run


def _cell_of_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("cell", ignore_index=True)
    shards, sums = differences([list(map(int, s)) for s in pdf["sums"]])
    return pd.DataFrame(
        {
            "cell": pdf["cell"],
            "parent": pdf["parent"],
            "places": list(shards),
            "total": [sums] * len(pdf),
        }
    )


def balanced_groups(groups: DataFrame, shards: int, cell: int = CELL) -> DataFrame:
    """``group``, ``bytes`` -> ``group``, ``shard``: groups dealt to shards by differencing.

    ``groups`` is stored and has one row per group. No groups give no rows. A single group larger
    than a shard's fair part fills its shard alone; the others share what is left.
    """
    cells = max(1, -(-groups.count() // cell))
    leaves = cut(
        groups.withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(cells)))
        .groupBy("cell")
        .applyInPandas(_cell_of_groups(shards), "group binary, bytes long, cell long, place int")
    )
    each = [F.sum(F.when(F.col("place") == s, F.col("bytes")).otherwise(0)) for s in range(shards)]
    level = leaves.groupBy("cell").agg(F.array(*each).alias("sums"))
    steps = []
    while cells > 1:
        cells = -(-cells // cell)
        step = cut(
            level.withColumn("parent", F.floor(F.col("cell") / cell))
            .groupBy("parent")
            .applyInPandas(
                _cell_of_sums, "cell long, parent long, places array<int>, total array<long>"
            )
        )
        steps.append(step)
        level = step.groupBy("parent").agg(F.first("total").alias("sums")).withColumnRenamed(
            "parent", "cell"
        )
    if not steps:
        return leaves.select("group", F.col("place").alias("shard"))
    # The places of a cell through all its ancestors: one small row per cell.
    path = steps[0].select("cell", "parent", "places")
    for step in steps[1:]:
        up = step.select(
            F.col("cell").alias("parent"), F.col("parent").alias("next"), F.col("places").alias("up")
        )
        path = path.join(up, "parent").select(
            "cell",
            F.col("next").alias("parent"),
            F.transform("places", lambda p: F.get("up", p)).alias("places"),
        )
    return leaves.join(path.select("cell", "places"), "cell").select(
        "group", F.get("places", F.col("place")).alias("shard")
    )


def shards_by_bytes(docs: DataFrame, shards: int = 16, cell: int = CELL) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` for every row of ``docs``.

    Size is UTF-8 bytes plus 1; null texts count as no bytes and are a group with the empty ones.
    Rows of equal texts share a shard. Slots count the rows of a shard from 0 without gaps, in a
    shuffled order that depends on doc_id and text; equal rows may swap theirs.
    """
    text = F.coalesce("text", F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        )
    )
    groups = cut(rows.groupBy("group").agg(F.sum("size").alias("bytes")))
    placed = rows.join(balanced_groups(groups, shards, cell), "group")
    one = cut(placed.withColumn("one", F.lit(1).cast("bigint")))
    return running_sum(one, ["shard"], ["doc_id", "group"], "one", "upto").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("upto") - 1).alias("slot")
    )
