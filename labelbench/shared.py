"""Where intermediate tables live, and how long plans are cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

_stored: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is missing and the session is local.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = context.getCheckpointDir()
        if current:
            return current
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="labelbench-")
    elif folder.startswith("file:") and not context.master.startswith("local"):
        # It may be a mounted network folder, which only the cluster's owner knows.
        warnings.warn(f"{folder} must be a folder that all executors share", stacklevel=2)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table; :func:`release` deletes what was written there."""
    if not _stored:
        atexit.register(_release_at_exit, spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _stored.append(path)
    return path


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables stored so far, or those from number ``since`` on.

    Call it when the results that read them are written. What is left goes at the end of the
    application.
    """
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while len(_stored) > since:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_stored.pop())
        path.getFileSystem(conf).delete(path, True)


def _release_at_exit(spark: SparkSession) -> None:
    with suppress(Exception):  # the session may be gone with its JVM
        release(spark)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables stored inside at the end. Results must be used up by then."""
    since = len(_stored)
    try:
        yield
    finally:
        release(spark, since)


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` once as a table in the shared folder and go on from the stored rows.

    Everything that reads its input more than once starts here: the source is scanned a single
    time, and a lost executor costs a re-read of the stored rows, not of the whole plan. Readers
    of the table still take only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def balanced(df: DataFrame) -> DataFrame:
    """Even out partition sizes by the rows as they are now.

    A few numbers per text leave the partitions of a text scan almost empty, and every iteration
    of a fit would pay for each of them. Spark merges and splits by the measured sizes.
    """
    return df.hint("rebalance")
