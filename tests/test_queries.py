"""Every registered query: equal to its SQL, or at least whole and well-formed."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from compare import connect, differences
from labelbench.plans import analysis_queries
from labelbench.plans import queries as queries_module
from labelbench.shared import cut

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
# Whole grids take minutes each; the comparison of all queries with their SQL runs them, and the
# tests of models hold searches over small grids against the library.
WHOLE_GRIDS = {"rf_sweep_orders", "rf_cross_validation_orders", "holdout_search_orders"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - WHOLE_GRIDS))
def test_query_equals_sql(spark, db, name):
    assert differences(QUERIES[name](spark, FOLDER), db, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.endswith("_holdout")))
def test_holdout_reports_every_test_row(spark, db, name):
    row = QUERIES[name](spark, FOLDER).first()
    assert (row["n"], row["n_neg"], row["n_pos"]) == (19, 3, 16)
    assert 0 <= row["n_errors"] <= row["n"]
    assert 0 <= row["roc"] <= 1 and 0 <= row["pr"] <= 1


def test_random_split_counts_cover_the_table(spark, db):
    total = db.execute("SELECT count(*) FROM orders").fetchall()[0][0]
    rows = QUERIES["random_split_counts"](spark, FOLDER).collect()
    assert sorted(r["split"] for r in rows) == ["test", "train"]
    assert sum(r["n"] for r in rows) == total


def test_entry_gives_one_report(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["n"] == 19


@pytest.mark.parametrize("few_trees", [False, True])
def test_a_layout_comes_back_in_all_its_parts(spark, monkeypatch, few_trees):
    """Stored, its small files were read packed together, more of them the more there were."""
    monkeypatch.setattr(queries_module, "ROWS_PER_TASK", 10)
    rows = spark.range(600).select((F.col("id") % 300).alias("key"), F.col("id").alias("value"))
    laid_out = queries_module._laid_out(cut(rows), "key", few_trees=few_trees)
    train = laid_out.where("key >= 0")
    parts = train.groupBy(F.spark_partition_id().alias("part")).count().collect()
    assert train.rdd.getNumPartitions() == 61
    assert max(r["count"] for r in parts) < 60


def test_parts_do_not_grow_with_the_rows():
    for rows in (0, 99_999, 600_000, 36_000_000, 216_000_000):
        assert rows / queries_module._parts(rows) <= queries_module.ROWS_PER_TASK
        few = queries_module._parts(rows, few_trees=True)
        assert rows / few <= queries_module.ROWS_PER_LARGE_TASK
        assert few <= queries_module._parts(rows)
    assert queries_module._parts(5, least=2) == 2


def test_deep_forests_are_spread_over_cores():
    assert queries_module._parts(4_000) == 1
    assert queries_module._parts(100_000) >= 4
    assert queries_module._parts(205_000) >= 8
    assert queries_module._parts(1_200_000) == 16  # beyond that, parts grow to 100,000 rows first
    assert queries_module._parts(54_000_000) == 541


def test_banded_orders_take_more_parts_when_there_are_more(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries_module, "ROWS_PER_TASK", 10)
    orders = spark.range(200).select(
        F.col("id").alias("o_orderkey"), F.concat(F.col("id") % 5 + 1, F.lit("-X")).alias("o_orderpriority")
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert analysis_queries._banded_orders(spark, str(tmp_path)).rdd.getNumPartitions() == 21
