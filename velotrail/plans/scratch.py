"""Shared folder for intermediate tables that must survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may go without."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="velotrail-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/velotrail/{label}-{uuid.uuid4().hex}"


def write_out(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written out inside are deleted at the end; results must have been written or counted by then."""
    token = _owned.set([])
    try:
        yield
    finally:
        paths = _owned.get()
        _owned.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting that holds inside and is as before at the end."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
