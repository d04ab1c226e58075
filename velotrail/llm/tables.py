"""Joins on hot keys, connected components and batch functions shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.spans import kept
from velotrail.plans.scratch import write_out

#: Rows and bytes handed to Python at a time, so that batches of long texts stay small; one row may be larger.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: A group with more than 1/HOT of the rows is joined by broadcast.  There can be HOT such groups at most.
HOT = 1024


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of BATCH_ROWS rows and BATCH_BYTES; the settings stay, since the plan is made later."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(_tidy(fn), schema)


def _tidy(fn):
    """``fn``, in a worker that keeps nothing of other stages, and after which it gives freed memory back to the system."""

    def run(batches):
        stage, last = TaskContext.get().stageId(), kept("stage")
        if last.get("id") != stage:
            kept("encoders").clear()
            last["id"] = stage
        yield from fn(batches)
        give_back()

    return run


def give_back() -> None:
    """Freed memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library than glibc


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Add the columns of ``groups`` (one row per key, ``size`` rows each in ``rows``) to ``rows``; keys without group go.

    Groups larger than total/HOT, at most HOT of them, are broadcast, so that their rows need no shuffle.  No other
    key holds more than that share, which bounds the shuffled join's tasks.
    """
    big = F.col(size) > total / HOT
    hot = F.broadcast(groups.filter(big))
    cold = rows.join(F.broadcast(groups.filter(big).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(cold.join(groups.filter(~big), key))


#: Tables of at most so many bytes are broadcast.
SMALL = 32 << 20


def small(table: DataFrame, row_bytes: int) -> DataFrame:
    """``table`` (written out) marked for broadcast if its rows, of at most so many bytes, fit SMALL; else as it is."""
    return F.broadcast(table) if table.count() * row_bytes <= SMALL else table


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's connected component; links has columns a and b.

    Each round takes the smallest label among neighbours and then the label of that label, so a path of n nodes needs
    about log n rounds.  A round writes its labels to the shared folder.
    """
    edges = write_out(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = write_out(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                       .select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        known = small(labels, 32)
        near = (edges.join(known.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("m")))
        best = near.join(known, "node").select("node", F.col("root").alias("was"), F.least("root", "m").alias("via"))
        step = best.join(known.select(F.col("node").alias("via"), F.col("root").alias("next")), "via").select(
            "node", "was", F.least("via", "next").alias("root"))
        step = write_out(step, "labels")
        changed = step.filter("was <> root").limit(1).count()
        labels = step.select("node", "root")
        if not changed:
            return labels
