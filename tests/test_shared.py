from pathlib import Path

import pytest
from pyspark.sql import functions as F

from labelbench.plans.queries import header_removed
from labelbench.shared import cut, release, scratch, scratch_path, shared_folder
from labelbench.sources import text_samples

FOLDER = "/root/testdata/sf0.001"


def test_cut_keeps_rows_and_drops_the_plan(spark):
    df = spark.range(100).select((F.col("id") * 2).alias("twice"))
    stored = cut(df)
    assert sorted(stored.collect()) == sorted(df.collect())
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_scratch_paths_are_fresh_and_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))


def test_stored_tables_are_deleted_after_use(spark, tmp_path):
    release(spark)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    with scratch(spark):
        assert cut(spark.range(10)).count() == 10
        assert list(folder.glob("stored-*"))
    assert not list(folder.glob("stored-*"))
    cut(spark.range(10))
    release(spark)
    assert not list(folder.glob("stored-*"))


def test_a_workflow_leaves_no_tables(spark, tmp_path):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    release(spark)
    header_removed(spark, FOLDER).count()
    release(spark)
    assert not [p for p in folder.iterdir() if p.name.startswith(("stored-", "headed-"))]


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_no_text_crosses_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = text_samples(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    above_the_scans = plan[: plan.rindex("Exchange hashpartitioning")]
    join_part = above_the_scans[: above_the_scans.index("Exchange hashpartitioning")]
    assert "text#" not in join_part
    assert "ReadSchema: struct<doc_id:bigint,text:string,n_chars:bigint>" in plan
