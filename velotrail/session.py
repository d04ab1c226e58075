"""A local session for tests, checks and the bench.  On a cluster, bring your own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
