"""History and recent tables in parquet folders, written batch by batch.

A batch belongs to a run: one stream (by its checkpoint) or one call, so nothing that another writer brought is ever replaced;
repeating a batch of a run overwrites its folder alone and changes nothing.  Reading takes the newest settled copy with the
batches that are in none (``sources.log``), and settles keys that appear several times: newest write for the history, highest
``n`` for the recent set.  So it does no harm if a batch is in a copy and comes once more.  Nothing is read and overwritten in
place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from velotrail.operators.distribute import union_sources
from velotrail.operators.history import HISTORY, bucket_of, history_rows, newest_rows
from velotrail.operators.parse import parse_line
from velotrail.operators.recent import keep_last_n, merge_members, recent_set, with_member
from velotrail.sources.log import BATCH_SCHEMA, CALL, Log, Snapshot, new_run, only, stored

BUCKETS = 64
HISTORY_SCHEMA = (
    "row_key string, vehicle_id string, event_ms bigint, longitude string, latitude string, "
    "angle string, velocity string, arrival_ms bigint, bucket int"
)
RECENT_SCHEMA = "vehicle_id string, score double, line string, arrival_ms bigint, bucket int"

# The member is ``line@arrival`` and is made again on reading.
STORED = ("vehicle_id", "score", "line", "arrival_ms")


def _save(rows: DataFrame, folder: str, order: list[str], buckets: int) -> None:
    """Bucket folders with sorted files; Spark splits a hot vehicle's bucket over several tasks by its size."""
    placed = rows.withColumn("bucket", bucket_of(F.col("vehicle_id"), buckets)).hint("rebalance", "bucket")
    placed.sortWithinPartitions("bucket", *order).write.mode("overwrite").partitionBy("bucket").parquet(folder)


def _add(rows: DataFrame, path: str, order: list[str], buckets: int, run: str | None, batch_id: int) -> None:
    log, run = Log(rows.sparkSession, path), run or new_run()
    _save(rows, log.folder(run, batch_id), order, buckets)
    log.add(run, batch_id)


def _rows(log: Log, schema: str, now: Snapshot, settled: bool = False, ids: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """What a snapshot stands for; the batches of all runs are read by their folders."""
    def of(rows: DataFrame) -> DataFrame:
        return rows if ids is None else only(rows, ids, "vehicle_id", buckets)

    copy = of(stored(log.spark, log.settled(now.version), schema)) if now.version else log.spark.createDataFrame([], schema)
    if settled or not now.batches:
        return copy
    live = stored(log.spark, f"{log.path}/live", f"{schema}, {BATCH_SCHEMA}", [log.folder(*b) for b in now.batches])
    return union_sources(copy, of(live.drop("run", "batch_id")))


def _compact(spark: SparkSession, path: str, schema: str, settle, order: list[str], buckets: int, newest: bool) -> bool:
    """Write a new settled copy.  False if there is nothing new to cover."""
    log = Log(spark, path)
    now = log.snapshot()
    last = {run: n for run, n in now.batches}  # batches ascend
    taken = [(run, n) for run, n in now.batches if newest or run.startswith(CALL) or n < last[run]]
    if not taken:
        return False
    rows = _rows(log, schema, Snapshot(now.version, tuple(taken)))
    _save(settle(rows), log.settled(now.version + 1), order, buckets)
    log.settle(now.version + 1, taken)
    return True


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """What the table holds now, for reads that must agree whatever is written between them (see ``clean_table``)."""
    return Log(spark, path).snapshot()


def clean_table(spark: SparkSession, path: str) -> int:
    """Delete batches that the newest settled copy holds, and older copies; returns the number of batches.

    Not while someone reads an older snapshot or writes a batch of the copy again.
    """
    return Log(spark, path).clean()


class Latency:
    """Count, total and average of (now - sent) of the lines of a batch, taken while the batch is written.

    ``now_ms``: a clock, or None for the arrival of each line.
    """

    def __init__(self, now_ms: int | None = None):
        self._observation, self._now = Observation(), now_ms

    def watch(self, track: DataFrame) -> DataFrame:
        now = F.col("arrival_ms") if self._now is None else F.lit(self._now).cast("bigint")
        late = (now - F.col("event_ms")).cast("double")
        return track.observe(self._observation, F.count(F.lit(1)).alias("n"), F.sum(late).alias("total_ms"), F.avg(late).alias("avg_ms"))

    def save(self, spark: SparkSession, path: str, run: str | None, batch_id: int) -> None:
        """Nothing for a batch without lines."""
        found = self._observation.get
        if found["n"]:
            row = spark.createDataFrame([(found["n"], found["total_ms"], found["avg_ms"])], "n bigint, total_ms double, avg_ms double")
            write_metrics(row, path, run, batch_id)


def write_history(
    lines: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "strict", run: str | None = None, batch_id: int = 0,
    latency: Latency | None = None,
) -> None:
    """Put a batch of stamped lines (line, arrival_ms) into the history table.

    Without ``run`` every call adds a batch of its own.  Batches may come in any order; one that is repeated replaces what it
    brought, or, once a settled copy holds that, adds to it.  ``latency`` gets the statistics of its lines.
    """
    parsed = history_rows(lines, mode)
    rows = newest_rows(latency.watch(parsed) if latency else parsed).select(*HISTORY)
    _add(rows, path, ["row_key"], buckets, run, batch_id)


def read_history(
    spark: SparkSession, path: str, settled: bool = False, at: Snapshot | None = None, ids: DataFrame | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """The table with one row per key; filters on vehicle_id, row_key and bucket reach the files.

    ``settled``: only what the newest settled copy holds, whose keys are unique: a plain scan, no shuffle.  ``at``: as it was
    at a ``snapshot``.  ``ids``: only the vehicles in a frame (vehicle_id); with few of them only their buckets are opened, of
    the ``buckets`` that the table was written with.
    """
    log = Log(spark, path)
    rows = _rows(log, HISTORY_SCHEMA, at or log.snapshot(), settled, ids, buckets)
    return rows if settled else newest_rows(rows)


def compact_history(spark: SparkSession, path: str, buckets: int = BUCKETS, newest: bool = False) -> bool:
    """Settle the table into a new copy; the batches in it are not read any more.

    The newest batch of a stream may be repeated and stays out, unless ``newest``.  One compaction at a time.
    """
    return _compact(spark, path, HISTORY_SCHEMA, lambda rows: newest_rows(rows).select(*HISTORY), ["row_key"], buckets, newest)


def write_recent(
    lines: DataFrame, path: str, n: int = 1000, dedup: str = "line", buckets: int = BUCKETS, mode: str = "strict",
    run: str | None = None, batch_id: int = 0, latency: Latency | None = None,
) -> None:
    """Add a batch of stamped lines to the recent sets; at most ``n`` per vehicle are written.  Runs as for the history."""
    parsed = parse_line(lines, mode=mode)
    track = parsed if mode == "strict" else parsed[0]
    kept = keep_last_n(recent_set(latency.watch(track) if latency else track, dedup), n, count_in=track)
    _add(kept.select(*STORED), path, ["vehicle_id", "score", "line"], buckets, run, batch_id)


def read_recent(
    spark: SparkSession, path: str, n: int = 1000, dedup: str = "line", settled: bool = False, at: Snapshot | None = None,
    ids: DataFrame | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """The ``n`` newest members per vehicle; the rest as for the history, ``settled`` with the ``n`` of the compaction."""
    log = Log(spark, path)
    rows = _rows(log, RECENT_SCHEMA, at or log.snapshot(), settled, ids, buckets)
    return with_member(rows) if settled else keep_last_n(merge_members(rows, dedup), n, count_in=rows)


def compact_recent(
    spark: SparkSession, path: str, n: int = 1000, dedup: str = "line", buckets: int = BUCKETS, newest: bool = False
) -> bool:
    """As for the history; members beyond the ``n`` newest are left out."""
    def settle(rows: DataFrame) -> DataFrame:
        return keep_last_n(merge_members(rows, dedup), n, count_in=rows).select(*STORED)

    return _compact(spark, path, RECENT_SCHEMA, settle, ["vehicle_id", "score", "line"], buckets, newest)


def _plain_folder(path: str, run: str | None, batch_id: int) -> str:
    return f"{path.rstrip('/')}/live/run={run or new_run()}/batch_id={batch_id}"


def write_rejects(lines: DataFrame, path: str, split_key: bool = True, run: str | None = None, batch_id: int = 0) -> None:
    """The lines that a lenient batch leaves out, with the reason."""
    _, rejects = parse_line(lines, mode="lenient", split_key=split_key)
    rejects.write.mode("overwrite").parquet(_plain_folder(path, run, batch_id))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return stored(spark, f"{path.rstrip('/')}/live", f"line string, reason string, {BATCH_SCHEMA}")


def write_metrics(metrics: DataFrame, path: str, run: str | None = None, batch_id: int = 0) -> None:
    """One row of batch statistics under the batch's own folder."""
    metrics.coalesce(1).write.mode("overwrite").parquet(_plain_folder(path, run, batch_id))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return stored(spark, f"{path.rstrip('/')}/live", f"n bigint, total_ms double, avg_ms double, {BATCH_SCHEMA}")


def write_report(rows: DataFrame, path: str, run: str | None = None, batch_id: int = 0) -> None:
    """What a batch completes, under the batch's own folder."""
    rows.write.mode("overwrite").parquet(_plain_folder(path, run, batch_id))


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return stored(spark, f"{path.rstrip('/')}/live", f"{schema}, {BATCH_SCHEMA}").drop("run", "batch_id")
