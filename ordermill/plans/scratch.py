"""Where intermediate tables are written, and session settings for one write."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Months that a task has files open for at once; with more of them it sorts its rows by month.
OPEN_MONTHS = 100


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, or one in the warehouse folder where that is not set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name nobody else uses; nothing is created yet."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder and what it holds, in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    """A block in which a setting of the session has another value."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def month_writers(spark: SparkSession):
    """A block whose tasks write rows of many months as they come, each month to a file of its own.

    So rows need no shuffle and no sort by month.  A task reads at most a split of the staged rows, so files are as many as splits
    times months.
    """
    return session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_MONTHS)
