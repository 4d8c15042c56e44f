"""The conversation trie against brute force."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from labelbench.llm import conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string, extra string, depth string, a string"


def _rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def _brute(rows):
    convs = _rebuilt(rows)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for prefix, own in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not children[prefix]
            saved[prefix[:d]] += (len(own) - 1) * (len(prefix[-1][1]) if prefix else 0)
    return Counter(
        (
            min(own),
            len(prefix),
            min(members[prefix[:-1]]) if prefix else None,
            len(own),
            children[prefix],
            leaves[prefix],
            saved[prefix],
            sha256(",".join(map(str, sorted(ends[prefix]))).encode()).hexdigest(),
        )
        for prefix, own in members.items()
    )


def _odd_conversations():
    rng = random.Random(11)
    rows = [
        (None, 0, "user", "no conversation"),
        (-5, 1, "user", "negative"),
        (-5, None, None, "null turn first"),
        (-100, 2, "user", None),
        (-100, 1, None, ""),
        (7, 0, "user", "ab"),
        (7, 1, "user", "ab"),
        (8, 0, "usera", "b"),
        (900, 5, None, None),
    ]
    for conv in [*range(100, 160), *range(300, 330), 401, 402]:
        start = rng.choice(["hello", "hello", "héllo", ""])
        turns = [start, *[rng.choice("abcd") * rng.randint(0, 3) for _ in range(rng.randint(0, 9))]]
        rows += [(conv, i * 10, "ua"[i % 2], t) for i, t in enumerate(turns)]
    rows += [(conv, i, "user", f"long {i}") for conv in (600, 601, 602) for i in range(70)]
    rows += [(603, i, "user", f"long {i}" if i < 50 else "other") for i in range(70)]
    rows += [(conv, 0, "user", "a copy") for conv in range(700, 760)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def placed(spark):
    return conversations.cut(conversations.placed_turns(_frame(spark, _odd_conversations())))


@pytest.mark.parametrize(("block", "together"), [(4, 1024), (3, 2)])
def test_nodes_equal_brute_force(placed, monkeypatch, block, together):
    """Also with so few blocks in a window that running digests go over several of them."""
    monkeypatch.setattr(conversations, "BLOCKS_TOGETHER", together)
    turns, convs = conversations.rebuilt(placed)
    found = conversations.prefix_trie(conversations.cut(turns), convs, block_turns=block)
    assert Counter(map(tuple, found.collect())) == _brute(_odd_conversations())


def test_places_do_not_depend_on_the_ranges(spark, placed, monkeypatch):
    monkeypatch.setattr(conversations, "TURNS_PER_RANGE", 20)
    parted = conversations.placed_turns(_frame(spark, _odd_conversations()))
    assert sorted(map(tuple, parted.collect())) == sorted(map(tuple, placed.collect()))


def test_the_registered_query(spark, tmp_path):
    rows = _odd_conversations()[:40]
    _frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op12_prefix_trie(spark, str(tmp_path))
    assert {t for _, t in found.dtypes if _ != "ends_sha256"} == {"bigint"}
    assert Counter(map(tuple, found.collect())) == _brute(rows)


@pytest.mark.parametrize("rows", [[], [(901, 0, "user", "its base is absent")]])
def test_hardly_any_conversations(spark, rows):
    placed = conversations.cut(conversations.placed_turns(_frame(spark, rows)))
    turns, convs = conversations.rebuilt(placed)
    found = conversations.prefix_trie(conversations.cut(turns), convs).collect()
    assert Counter(map(tuple, found)) == (_brute(rows) if rows else Counter())
