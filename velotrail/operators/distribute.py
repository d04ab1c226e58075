"""Dealing records to queues and partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.functions.text import key_bucket
from velotrail.plans.ranks import table_rank


def union_sources(*frames: DataFrame) -> DataFrame:
    """Several readers of one topic as one frame or stream (bag union)."""
    return reduce(DataFrame.unionByName, frames)


def deal(df: DataFrame, n: int) -> DataFrame:
    """Deal rows in turn to ``n`` partitions."""
    return df.repartition(n)


def deal_in_order(df: DataFrame, n: int, order: list[Column], queue: str = "queue") -> DataFrame:
    """The queue that each record gets when records are dealt in turn in a given order."""
    ranked, _ = table_rank(df, order, "_rank")
    return ranked.withColumn(queue, (F.col("_rank") % n).cast("int")).drop("_rank")


def partition_by_hash(df: DataFrame, n: int, key: str = "vehicle_id") -> DataFrame:
    """Place rows in ``n`` partitions by the 32-bit key hash, and say which."""
    placed = df.withColumn("partition_no", key_bucket(F.col(key), n))
    return placed.repartitionById(n, F.col("partition_no"))


def with_parallelism(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)
