"""Near-duplicate groups by exact Jaccard similarity of word shingles, with prefix trees.

1. One scan gives each document the size and a digest of its shingle set, and counts how often
   shingles occur, in a table of fixed size. Equal sets are one from here on.
2. Shingles are ordered by that count, rare ones first, then by hash. Two similar sets share ``l``
   of their first ``n - ceil(t n) + l`` shingles. These go, packed, to slices of the hash space,
   which find those that several sets hold and return them as Bloom filters. With these, a second
   scan leaves out sets with fewer than ``l`` such shingles, which have no similar set, and sends the
   rest of the very first ones to the slices: sets that share one are a bucket. Buckets inside
   another one are left out.
3. Sets that remain are made once more, and each goes to its largest bucket, where a prefix tree
   links similar ones. That gives first components.
4. Buckets that still hold several components are walked again, only across these. The links found
   there are joined into the final components.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelbench.llm import bloom
from labelbench.llm.batches import column, give_back, runs, text_bytes
from labelbench.llm.shingles import shingle_sets
from labelbench.llm.trie import linked
from labelbench.shared import cut

RUN_BYTES = 1 << 19
COUNTERS = 1 << 20
COUNT_SLICES = 64
RANK_BITS = 6
SHARED_PART = 10  # similar sets share a tenth of their size among their first shingles
MOST_SETS = 4096  # in one prefix tree
MOST_OTHERS = 512  # of these outside the largest component, in the tree of a whole cluster
SENT_ROWS = 200_000  # decisions on documents that may be sent to the tasks
SHINGLES_PER_SLICE = 1_000_000  # of distinct sets; a slice gets about a third of them
IDS_PER_ROW = 1 << 16
TASK_BYTES = 8 << 20  # of sets that one call of the tree function gets


def _runs(batches: Iterator[pa.RecordBatch], width: int):
    """(batch of whole rows, row of each shingle, its hash) for runs of texts."""
    for batch in batches:
        for part in runs(batch, RUN_BYTES):
            yield part, *shingle_sets(text_bytes(part).to_pylist(), width)
    give_back()


def _sets(owner: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    rows, starts = np.unique(owner, return_index=True)
    return zip(rows.tolist(), np.split(values, starts[1:]) if len(rows) else [])


def _digest(hashes: np.ndarray) -> bytes:
    return blake2b(hashes.tobytes(), digest_size=16).digest()


def _heads(digests: Iterable[bytes]) -> np.ndarray:
    """The first eight bytes of each as a number, its last bit left free."""
    heads = np.frombuffer(b"".join(d[:8] for d in digests), ">u8").astype(np.uint64)
    return heads & ~np.uint64(1)


def measured(docs: DataFrame, width: int) -> DataFrame:
    """Rows of two kinds: ``doc_id``, ``md5`` of the text, ``n``, ``digest`` (null for an empty set),
    and per task the packed ``counts`` of each part of the counter table."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("md5", pa.string()),
            ("n", pa.int64()),
            ("digest", pa.binary()),
            ("part", pa.int64()),
            ("counts", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for part, owner, hashes in _runs(batches, width):
            at = (hashes >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)
            counts += np.bincount(at, minlength=COUNTERS)
            digests: list = [None] * part.num_rows
            for row, values in _sets(owner, hashes):
                digests[row] = _digest(values)
            n = np.bincount(owner, minlength=part.num_rows)
            nothing = pa.nulls(part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    column(part, "doc_id"),
                    column(part, "md5"),
                    pa.array(n, pa.int64()),
                    pa.array(digests, pa.binary()),
                    nothing.cast(pa.int64()),
                    nothing.cast(pa.binary()),
                ],
                schema=schema,
            )
        blobs = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, COUNT_SLICES)]
        empty = pa.nulls(COUNT_SLICES)
        yield pa.RecordBatch.from_arrays(
            [
                empty.cast(pa.int64()),
                empty.cast(pa.string()),
                empty.cast(pa.int64()),
                empty.cast(pa.binary()),
                pa.array(range(COUNT_SLICES), pa.int64()),
                pa.array(blobs, pa.binary()),
            ],
            schema=schema,
        )

    return docs.select("doc_id", "text", F.md5("text").alias("md5")).mapInArrow(
        run, "doc_id long, md5 string, n long, digest binary, part long, counts binary"
    )


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(blob), np.int64) for blob in pdf["counts"])
    return pd.DataFrame({"part": pdf["part"].iloc[:1], "counts": [zlib.compress(total.tobytes(), 1)]})


def _ranks(counts: DataFrame) -> np.ndarray:
    """Rank by count for each counter: twice its base-2 logarithm. The table has a fixed size."""
    schema = "part long, counts binary"
    few = counts.groupBy("part", F.pmod(F.xxhash64("counts"), F.lit(64))).applyInPandas(_added, schema)
    rows = few.groupBy("part").applyInPandas(_added, schema).collect()
    total = np.zeros((COUNT_SLICES, COUNTERS // COUNT_SLICES), np.int64)
    for row in rows:
        total[row["part"]] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    ranks = np.floor(2 * np.log2(total.ravel() + 1.0))
    return np.minimum(ranks, (1 << RANK_BITS) - 1).astype(np.uint8)


def _ordered(owner: np.ndarray, hashes: np.ndarray, ranks: np.ndarray):
    """Shingles as numbers whose order is the global one, sorted within each row."""
    rank = ranks[(hashes >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)]
    # The rank takes the place of the lowest bits; the highest stay below it.
    keys = (rank.astype(np.uint64) << np.uint64(64 - RANK_BITS)) | (hashes >> np.uint64(RANK_BITS))
    order = np.lexsort((keys, owner))
    return owner[order], keys[order]


def _least(n, percent: int):
    """The size that an overlap, or a similar set, has at least: ceil(percent * n / 100)."""
    return (percent * n + 99) // 100


def _shared_least(n: int) -> int:
    """How many of their first shingles similar sets share, by the smaller of the two sizes."""
    return max(1, n // SHARED_PART)


def _joined_postings(blobs: Iterable[bytes], width: int) -> np.ndarray:
    """Distinct postings of ``width`` numbers, sorted by their first two: a shingle and an id."""
    data = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, width)
    data = data[np.lexsort((data[:, 1], data[:, 0]))]
    new = np.ones(len(data), bool)
    new[1:] = (data[1:, :2] != data[:-1, :2]).any(axis=1)
    return data[new]  # copies in several tasks


def _shared(postings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and length of each shingle that several ids hold."""
    starts = np.flatnonzero(np.append(True, postings[1:, 0] != postings[:-1, 0])[: len(postings)])
    sizes = np.diff(np.append(starts, len(postings)))
    return starts[sizes > 1], sizes[sizes > 1]


def _filter_of_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: a filter of the shingles of the slice that several sets hold."""
    postings = _joined_postings(pdf["postings"], 2)
    held = postings[_shared(postings)[0], 0]
    del postings
    packed = bloom.packed(held)
    give_back()
    return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "packed": [packed]})


def _times_of_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    """(id, times): how many shingles of the slice a set shares with others."""
    postings = _joined_postings(pdf["postings"], 2)
    starts, sizes = _shared(postings)
    rows = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    ids, times = np.unique(postings[rows, 1], return_counts=True)
    return pd.DataFrame({"id": ids.view(np.int64), "times": times})


def _buckets_of_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    """(bucket, part, ids): the sets that hold a shingle, in parts of bounded length; a bucket's
    name is a digest of its members.

    Postings are a shingle, an id, and the shingle that the set holds before it among those that may
    be shared, or 0. Where all members hold the same one before, its bucket has them all, and this
    one is left out. That depends on the sets only, not on how shingles fall into slices.
    """
    postings = _joined_postings(pdf["postings"], 3)
    names, parts, ids = [], [], []
    for start, size in zip(*(x.tolist() for x in _shared(postings))):
        before = postings[start : start + size, 2]
        if before[0] and (before == before[0]).all():
            continue
        members = np.ascontiguousarray(postings[start : start + size, 1])
        name = blake2b(members.tobytes(), digest_size=12).digest()
        for part, at in enumerate(range(0, size, IDS_PER_ROW)):
            names.append(name)
            parts.append(part)
            ids.append(members[at : at + IDS_PER_ROW].view(np.int64))
    del postings
    give_back()
    return pd.DataFrame({"bucket": names, "part": parts, "ids": pd.Series(ids, dtype=object)})


def _postings(docs: DataFrame, ranks, width: int, slices: int, chosen, fields: int) -> DataFrame:
    """``slice``, ``postings``: packed rows of ``fields`` numbers, dealt by their first.

    ``chosen`` gives the rows of one set from its ordered shingles and its id. Equal sets of one run
    of texts are one. An id is the head of a set's digest; sets that agree in it by chance are taken
    together, which can only add comparisons.
    """
    schema = pa.schema([("slice", pa.int64()), ("postings", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, owner, hashes in _runs(batches, width):
            digests = {row: _digest(values) for row, values in _sets(owner, hashes)}
            once = {digest: row for row, digest in digests.items()}
            found = [np.zeros((0, fields), np.uint64)]
            sets = _sets(*_ordered(owner, hashes, ranks.value))
            for (row, values), head in zip(sets, _heads(digests.values())):
                if once[digests[row]] == row:
                    found.append(chosen(values, head))
            records = np.concatenate(found)
            names, parts = bloom.by_slice(records[:, 0], slices)
            blobs = [records[part].tobytes() for part in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(blobs, pa.binary())], schema=schema
            )

    return docs.select("text").mapInArrow(emit, "slice long, postings binary")


def shared_filters(docs: DataFrame, ranks, width: int, percent: int, slices: int) -> DataFrame:
    """The postings by slice from which slices tell the shingles that several sets hold."""

    def chosen(values: np.ndarray, head: np.uint64) -> np.ndarray:
        n = len(values)
        tokens = values[: n - _least(n, percent) + _shared_least(n)]
        return np.column_stack([tokens, np.full(len(tokens), head)])

    return _postings(docs, ranks, width, slices, chosen, 2)


def shared_buckets(docs: DataFrame, ranks, width: int, percent: int, slices: int, filters) -> DataFrame:
    """The rows of :func:`_buckets_of_slice` of all slices. ``filters`` is a broadcast of the filters
    of shared shingles, or None: then no set and no shingle is left out beforehand."""

    def chosen(values: np.ndarray, head: np.uint64) -> np.ndarray:
        n = len(values)
        first = n - _least(n, percent) + 1
        tokens = values[:first]
        if filters is not None:
            hit = bloom.maybe_in(filters.value, values[: first - 1 + _shared_least(n)])
            tokens = tokens[hit[:first]] if hit.sum() >= _shared_least(n) else tokens[:0]
        before = np.concatenate([np.zeros(1, np.uint64), tokens])[: len(tokens)]
        return np.column_stack([tokens, np.full(len(tokens), head), before])

    return (
        _postings(docs, ranks, width, slices, chosen, 3)
        .groupBy("slice")
        .applyInPandas(_buckets_of_slice, "bucket binary, part long, ids array<long>")
    )


def _members(
    docs: DataFrame, sizes: DataFrame, ranks, width: int, percent: int, sent_bytes: int
) -> DataFrame:
    """``bucket``, ``id``: the buckets without sets that share too few of their first shingles to
    have a similar set.

    ``sizes`` has ``id``, ``n`` and ``least``, the number that a set shares at least with a similar
    one. Up to ``sent_bytes`` of filters are sent to the second scan; beyond that the shared shingles
    of each set are counted, and the buckets are joined with these counts.
    """
    shingles = sizes.agg(F.sum("n")).first()[0] or 0
    slices = bloom.slice_count(shingles, SHINGLES_PER_SLICE)
    postings = shared_filters(docs, ranks, width, percent, slices)
    filters = cut(
        postings.groupBy("slice").applyInPandas(_filter_of_slice, "slice long, packed binary")
    )
    size = filters.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    sent = None
    if size <= sent_bytes:
        sent = docs.sparkSession.sparkContext.broadcast(bloom.joined(slices, filters.collect()))
    buckets = shared_buckets(docs, ranks, width, percent, slices, sent)
    buckets = cut(buckets.dropDuplicates(["bucket", "part"]))
    members = buckets.select("bucket", F.explode("ids").alias("id"))
    if sent is not None:
        return members
    times = postings.groupBy("slice").applyInPandas(_times_of_slice, "id long, times long")
    shared = times.groupBy("id").agg(F.sum("times").alias("shared"))
    enough = shared.join(sizes, "id").where("shared >= least").select("id")
    return members.join(enough, "id").select("bucket", "id")


def _id(digest: str):
    """The first eight bytes as a signed number, as ``_heads`` has it."""
    head = F.hex(F.substring(digest, 1, 8))
    high, low = (F.conv(F.substring(head, i, 8), 16, 10).cast("long") for i in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low).bitwiseAND(F.lit(-2))


def _without_inner(buckets: DataFrame) -> DataFrame:
    """Leave out buckets that lie inside the largest bucket of all their members.

    Adds ``size`` and ``best``, the (size, bucket) of the largest bucket of the member.
    """
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sized = cut(buckets.join(sizes, "bucket"))
    best = sized.groupBy("id").agg(F.max(F.struct("size", "bucket")).alias("best"))
    known = cut(sized.join(best, "id"))
    outer = (
        known.groupBy("bucket")
        .agg(F.min("best").alias("low"), F.max("best").alias("high"))
        .where((F.col("low") != F.col("high")) | (F.col("low.bucket") == F.col("bucket")))
    )
    return cut(known.join(outer.select("bucket"), "bucket"))


def _candidate_sets(docs: DataFrame, members: DataFrame, ranks, width: int, sent_bytes: int) -> DataFrame:
    """``id``, ``digest``, ``tokens`` of the sets in ``members``, and of some others by chance."""
    slices = bloom.slice_count(members.count())

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = pdf["id"].to_numpy(np.int64).view(np.uint64)
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "packed": [bloom.packed(hashes)]})

    filters = cut(
        members.select("id")
        .distinct()
        .withColumn("slice", F.col("id").bitwiseAND(F.lit(slices - 1)))
        .groupBy("slice")
        .applyInPandas(pack, "slice long, packed binary")
    )
    size = filters.agg(F.sum(F.octet_length("packed"))).first()[0] or 0
    sent = None
    if size <= sent_bytes:
        sent = docs.sparkSession.sparkContext.broadcast(bloom.joined(slices, filters.collect()))
    schema = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("tokens", pa.binary())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, owner, hashes in _runs(batches, width):
            wanted = {row: _digest(values) for row, values in _sets(owner, hashes)}
            if sent is not None and wanted:
                hit = bloom.maybe_in(sent.value, _heads(wanted.values())).tolist()
                wanted = {row: d for (row, d), h in zip(wanted.items(), hit) if h}
            once = {digest: row for row, digest in wanted.items()}
            if not once:
                continue
            here = np.isin(owner, list(once.values()))
            sets = dict(_sets(*_ordered(owner[here], hashes[here], ranks.value)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_heads(once).view(np.int64)),
                    pa.array(list(once), pa.binary()),
                    pa.array([sets[row].tobytes() for row in once.values()], pa.binary()),
                ],
                schema=schema,
            )

    return (
        docs.select("text")
        .mapInArrow(emit, "id long, digest binary, tokens binary")
        .dropDuplicates(["id", "digest"])
    )


def _tree_links(rows: DataFrame, calls: int, percent: int) -> DataFrame:
    """``digest``, ``label``, ``found``: for each member of a (bucket, block), the smallest label of
    those it is linked with there.

    Rows: ``bucket``, ``block``, ``digest``, ``label``, ``tokens``. Many buckets share one call.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, members in pdf.groupby(["bucket", "block"], sort=False):
            members = members.sort_values("digest")
            labels = members["label"].tolist()
            roots = linked([np.frombuffer(t, np.uint64) for t in members["tokens"]], labels, percent)
            least: dict[int, bytes] = {}
            for root, label in zip(roots, labels):
                least[root] = min(least.get(root, label), label)
            out.append(members[["digest", "label"]].assign(found=[least[root] for root in roots]))
        return pd.concat(out, ignore_index=True)

    return (
        rows.withColumn("call", F.pmod(F.xxhash64("bucket", "block"), F.lit(calls)))
        .groupBy("call")
        .applyInPandas(run, "digest binary, label binary, found binary")
    )


def _blocks(size: str, name: str):
    """Blocks (i, j), i <= j, that a member of a bucket of ``size`` belongs to: all with its own
    part of the bucket, so any two members meet. A bucket of up to MOST_SETS has one block."""
    parts = F.ceil(F.col(size) / MOST_SETS)
    own = F.pmod(F.xxhash64(name), parts)
    return F.transform(
        F.sequence(F.lit(0).cast("long"), parts - 1),
        lambda other: F.least(own, other) * parts + F.greatest(own, other),
    )


def _pairs(n: str, most: str):
    """How many pairs to compare among ``n`` sets, of which the largest component has ``most``."""
    return F.col(n).cast("double") * (F.col(n) - F.col(most))


def _across(labelled: DataFrame, first: DataFrame) -> DataFrame:
    """``bucket``, ``block``, ``digest``, ``label``: what is compared across components.

    Components that meet in buckets form clusters. A cluster of bounded size is one bucket, so each
    of its sets is sent once however many buckets it is in. A larger one is one bucket too, in blocks,
    where that compares no more pairs than its buckets together; else these stay, but those of the
    same components are one.
    """
    group = F.concat(F.bit_xor(F.xxhash64("label")), F.lit("/"), F.bit_xor(F.xxhash64(F.lit(1), "label")))
    pairs = cut(labelled.select("bucket", "label").distinct())
    mixed = cut(
        pairs.groupBy("bucket")
        .agg(group.alias("group"), F.min("label").alias("low"), F.count(F.lit(1)).alias("several"))
        .where("several > 1")
        .select("bucket", "group", "low")
    )
    met = cut(pairs.join(mixed.select("bucket", "low"), "bucket").where("label != low"))
    roots = joined_components(met, "label", "low")
    roots = roots.union(roots.select(F.col("root").alias("node"), "root")).distinct()
    members = cut(
        first.join(roots, F.col("label") == F.col("node")).select("digest", "label", "root")
    )
    sizes = members.groupBy("root", "label").agg(F.count(F.lit(1)).alias("n"))
    clusters = cut(
        sizes.groupBy("root").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    )
    small = (F.col("n") <= MOST_SETS) & (F.col("n") - F.col("most") <= MOST_OTHERS)
    large = members.join(clusters.where(~small).select("root"), "root").select("root", "digest")
    grouped = cut(
        labelled.join(mixed.select("bucket", "group"), "bucket")
        .join(large, "digest")
        .select("root", "group", "digest", "label")
        .distinct()
    )
    group_sizes = cut(
        grouped.groupBy("root", "group", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root", "group")
        .agg(F.sum("n").alias("size"), F.max("n").alias("most"))
    )
    together = (
        group_sizes.groupBy("root")
        .agg(F.sum(_pairs("size", "most")).alias("pairs"))
        .join(clusters, "root")
        .where(_pairs("n", "most") <= F.col("pairs"))
        .select("root")
    )
    ones = cut(clusters.where(small).select("root", "n").union(clusters.join(together, "root").select("root", "n")))
    whole = (
        members.join(ones, "root")
        .withColumn("block", F.explode(_blocks("n", "digest")))
        .select(F.hex("root").alias("bucket"), "block", "digest", "label")
    )
    apart = (
        grouped.join(group_sizes.join(ones, "root", "left_anti").drop("most"), ["root", "group"])
        .withColumn("block", F.explode(_blocks("size", "digest")))
        .select(F.col("group").alias("bucket"), "block", "digest", "label")
    )
    return whole.union(apart)


def joined_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root``: the smallest node that each linked node reaches. ``links`` is stored.

    Alternating stars: every node passes its larger neighbours on to its smallest neighbour, then
    its smaller ones, until nothing changes.
    """
    edges = cut(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = cut(
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        changed = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def set_components(docs: DataFrame, found: DataFrame, ranks, width: int, percent: int, sent_bytes: int):
    """``digest``, ``label``: sets that may be linked with others, and their component's smallest.

    ``found`` has ``n`` and ``digest`` of every document.
    """
    least = F.greatest(F.lit(1), F.floor(_least_column("n", percent) / SHARED_PART))
    sizes = found.where("digest IS NOT NULL").select(_id("digest").alias("id"), "n", least.alias("least"))
    sizes = cut(sizes.groupBy("id").agg(F.max("n").alias("n"), F.min("least").alias("least")))
    buckets = _without_inner(cut(_members(docs, sizes, ranks, width, percent, sent_bytes)))
    sets = cut(_candidate_sets(docs, buckets, ranks, width, sent_bytes))
    measure = sets.agg(F.count(F.lit(1)), F.sum(F.octet_length("tokens"))).first()
    set_bytes = (measure[1] or 0) / max(1, measure[0])

    def calls(rows: int) -> int:
        return max(64, int(rows * set_bytes) // TASK_BYTES)

    # First every set in its largest bucket only.
    own = buckets.where(F.col("best.bucket") == F.col("bucket"))
    placed = own.join(sets, "id").select(
        "bucket",
        F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / MOST_SETS)).alias("block"),
        "digest",
        F.col("digest").alias("label"),
        "tokens",
    )
    first = cut(
        _tree_links(placed, calls(measure[0]), percent).select("digest", F.col("found").alias("label"))
    )
    # Then buckets that hold several components, across these.
    named = first.select(_id("digest").alias("id"), "digest", "label")
    labelled = cut(buckets.select("bucket", "id").join(named, "id").drop("id"))
    across = cut(_across(labelled, first))
    placed = across.join(sets.drop("id"), "digest")
    links = _tree_links(placed, calls(across.count()), percent)
    links = cut(links.select("label", "found").where("label != found").distinct())
    if links.isEmpty():
        return first
    roots = joined_components(links, "label", "found")
    return first.join(roots, F.col("label") == F.col("node"), "left").select(
        "digest", F.coalesce("root", "label").alias("label")
    )


def _least_column(n: str, percent: int):
    return F.floor((F.col(n) * percent + 99) / 100)


def _components(docs: DataFrame, width: int, percent: int, sent_bytes: int) -> DataFrame:
    """``doc_id``, ``md5``, ``n``, ``digest``, ``component``, ``component_id`` of every row. The
    component is a digest, null for documents without shingles."""
    spark = docs.sparkSession
    rows = cut(measured(docs, width))
    ranks = spark.sparkContext.broadcast(_ranks(rows.where("part IS NOT NULL").select("part", "counts")))
    found = rows.where("part IS NULL").select("doc_id", "md5", "n", "digest")
    labels = set_components(docs, found, ranks, width, percent, sent_bytes)
    ids = found.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"))
    named = cut(ids.join(labels, "digest", "left").withColumn("label", F.coalesce("label", "digest")))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = cut(named.join(least, "label").select("digest", F.col("label").alias("component"), "component_id"))
    return found.join(of_set, "digest", "left").withColumn(
        "component_id",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")),
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, sent_bytes: int = bloom.SENT_BYTES
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    Words are runs of characters other than ASCII white space, A-Z lower-cased. A document's set
    holds its distinct runs of ``width`` words; with fewer words, all of them as one. Documents
    whose sets have Jaccard similarity of at least ``percent`` / 100 are linked; ``component_id`` is
    the smallest doc_id that links reach. Null, empty and blank texts have no shingles and are their
    own component. A null doc_id never names a component if there is another. Rows that repeat a
    document are linked with it. Shingles are compared as 58 bits of hash with the rank.
    """
    return _components(docs, width, percent, sent_bytes).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id"
    )


def one_of_each(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    sent_bytes: int = bloom.SENT_BYTES,
    sent_rows: int = SENT_ROWS,
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id, null last.

    Rows are told apart by doc_id and text, so a clean text stays where its doc_id is also that of a
    near copy. Of rows that agree in both, the smallest by the other columns stays. Documents without
    shingles are nobody's copies and all stay. Up to ``sent_rows`` decisions are sent to the tasks;
    beyond that the documents are joined with them by doc_id and digest of the text.
    """
    found = cut(
        _components(docs, width, percent, sent_bytes)
        .where("component IS NOT NULL")
        .groupBy("component", F.col("doc_id").alias("_id"), F.col("md5").alias("_md5"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    order = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_md5")
    best = found.groupBy("component").agg(F.min(order).alias("best"), F.sum("rows").alias("rows"))
    best = best.where("rows > 1").select("component", "best")
    marks = found.join(best, "component").withColumn("_stays", order == F.col("best"))
    marks = cut(marks.where("NOT _stays OR rows > 1").select("_id", "_md5", "_stays"))
    if marks.count() <= sent_rows:
        marks = F.broadcast(marks)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_md5"))
    marked = docs.withColumn("_own", F.md5("text")).join(marks, same, "left")
    rows = F.struct(*[F.col(c) for c in docs.columns])
    sortable = [f.name for f in docs.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
    repeated = (
        marked.where("_stays")
        .groupBy("_id", "_md5")
        .agg(F.min_by(rows, F.struct(*sortable)).alias("row"))
        .select("row.*")
    )
    return marked.where("_stays IS NULL").select(*docs.columns).union(repeated)
