"""A session with the settings that the engine was tuned with."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster bring your own."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName("lymphlake")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
