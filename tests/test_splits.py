from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelbench.operators.splits import (
    hash_split,
    preview,
    random_split,
    stable_layout,
    tag_split,
    with_folds,
)


def _keys(df):
    return sorted(r[0] for r in df.collect())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(-(2**60), 2**60), unique=True, min_size=1, max_size=200))
def test_hash_split_covers_is_disjoint_and_ignores_layout(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "id bigint")
    train, test = hash_split(df, "id")
    assert _keys(train.union(test)) == sorted(keys)
    assert not set(_keys(train)) & set(_keys(test))
    again, _ = hash_split(df.repartition(5), "id")
    assert _keys(again) == _keys(train)


def test_split_and_folds_have_the_right_sizes(spark):
    df = with_folds(tag_split(spark.range(20000), "id"), "id")
    sizes = {tuple(r)[:2]: r["count"] for r in df.groupBy("split", "fold").count().collect()}
    assert len(sizes) == 6
    train = [n for (split, _), n in sizes.items() if split == "train"]
    assert abs(sum(train) / 20000 - 0.8) < 0.02
    # Independent digits: each fold takes a third of the train rows.
    assert all(abs(n / sum(train) - 1 / 3) < 0.02 for n in train)


def test_null_keys_go_to_one_side_only(spark):
    df = spark.createDataFrame([(None,), (1,)], "id bigint")
    tagged = tag_split(df, "id").collect()
    assert len(tagged) == 2


def test_random_split_covers(spark):
    df = spark.range(1000)
    train, test = random_split(df, seed=11)
    assert _keys(train.union(test)) == list(range(1000))
    assert 700 < train.count() < 900


def test_preview_is_ordered(spark):
    assert _keys(preview(spark.range(100).repartition(7), 3, [F.desc("id")])) == [97, 98, 99]


def test_stable_layout_ignores_the_input_layout(spark):
    a = stable_layout(spark.range(500), "id", 4)
    b = stable_layout(spark.range(500).repartition(9), "id", 4)
    place = [F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "id"]
    assert sorted(a.select(*place).collect()) == sorted(b.select(*place).collect())


def test_stable_layout_places_rows_that_share_a_key(spark):
    rows = spark.range(400).select((F.col("id") % 7).alias("key"), F.col("id").alias("value"))
    place = [F.monotonically_increasing_id().alias("at"), "key", "value"]
    a, b = (stable_layout(rows.repartition(n, "value"), "key", 3) for n in (1, 9))
    assert sorted(a.select(*place).collect()) == sorted(b.select(*place).collect())
