"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where a session has none and runs locally (tests, a laptop) a local
    folder is set; on a cluster that would be no shared folder, so it is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
    return context.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Rows of a small table's file, about.
FILE_ROWS = 1024


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have at most about ``rows`` rows, in no more partitions than these are worth; large tables keep theirs."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


#: Rows that a task sorts, about.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, known to have about ``rows`` rows, dealt by ``keys`` to as many tasks as keep what one sorts the same at any size; a small table is left as it is."""
    tasks = -(-rows // TASK_ROWS)
    return df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), *keys) if tasks > 1 else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again.

    The new DataFrame starts at files, so a lost executor costs a re-read and
    not the whole lineage, and later joins see plain scans, which the adaptive
    planner can split when a key is skewed.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
