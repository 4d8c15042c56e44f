"""Sharding and exact deduplication."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from labelbench.llm import cuckoo, sharding
from odd_docs import odd_rows


@pytest.mark.parametrize("cell", [4096, 7])
def test_shards_are_near_equal_and_keep_equal_texts(odd, cell):
    rows = sharding.shards_by_bytes(odd.where("doc_id <> 7 OR doc_id IS NULL"), 4, cell).collect()
    wanted = [(r[0], r[1] or "") for r in odd_rows() if r[0] != 7]
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(d), len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in wanted
    )
    of_text, slots, sizes = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        of_text[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(len(shards) == 1 for shards in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) == {0, 1, 2, 3}
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * max(sizes.values())


def test_differencing_beats_dealing_in_turn():
    rng = random.Random(3)
    sizes = [int(1000 * rng.paretovariate(1.2)) for _ in range(200)]
    shards, sums = sharding.differences([[0, 0, 0, s] for s in sizes])
    found = [0] * 4
    for place, size in zip(shards[:, -1], sizes):
        found[place] += size
    assert found == sums and sum(sums) == sum(sizes)
    dealt = [sum(sorted(sizes)[i::4]) for i in range(4)]
    assert max(sums) - min(sums) <= max(dealt) - min(dealt)


def test_no_rows_no_shards(no_docs):
    assert sharding.shards_by_bytes(no_docs).count() == 0


@pytest.mark.parametrize("keys_per_bucket", [4096, 5])
def test_exact_duplicates_equal_brute_force(odd, keys_per_bucket):
    rows = cuckoo.exact_duplicates(odd, keys_per_bucket).collect()
    groups = defaultdict(list)
    for doc, text, *_ in odd_rows():
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(bare.encode()).hexdigest()].append((doc, len(text or "")))
    for key, members in groups.items():
        found = [r for r in rows if r["text_sha256"] == key]
        best = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(m[0]) for m in members)
        assert {(r["keep_id"], r["group_size"]) for r in found} == {(best, len(members))}
        assert [r["doc_id"] for r in found if r["kept"]] == [best]
    assert len(rows) == len(odd_rows())


def test_no_rows_no_duplicates(no_docs):
    assert cuckoo.exact_duplicates(no_docs).count() == 0


def _digests(n, start=0):
    return [hashlib.sha256(str(i).encode()).digest() for i in range(start, start + n)]


def test_a_bucket_grows_and_forgets():
    bucket, keys = cuckoo.Bucket(), _digests(3000)
    assert all(map(bucket.insert, keys)) and not any(map(bucket.insert, keys))
    assert bucket.filter.cells * cuckoo.SLOTS >= 3000
    assert all(k in bucket for k in keys) and not any(k in bucket for k in _digests(3000, 5000))
    assert all(map(bucket.delete, keys[:1000])) and not bucket.delete(keys[0])
    assert not any(k in bucket for k in keys[:1000]) and all(k in bucket for k in keys[1000:])
    state = bucket.row(3).iloc[0]
    again = cuckoo.Bucket(state["filter"], state["digests"])
    assert again.live == bucket.live and all(k in again for k in keys[1000:])


def test_the_index_as_a_table(spark):
    def frame(keys):
        return spark.createDataFrame([(bytearray(k),) for k in keys], "digest binary")

    keys = _digests(300)
    index = cuckoo.insert(None, frame(keys[:200] + keys[:10]), 4).cache()
    index = cuckoo.insert(index, frame(keys[150:250]), 4)
    index = cuckoo.delete(index, frame(keys[:50] + keys[290:]), 4)
    live = {bytes(r["digest"]): r["live"] for r in cuckoo.lookup(index, frame(keys), 4).collect()}
    assert live == {k: 50 <= i < 250 for i, k in enumerate(keys)}
