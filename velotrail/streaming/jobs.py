"""Streams of track lines into the history, the recent sets and the latency log.

Every job has its own checkpoint, whose id names the run in the table.  The sinks overwrite the
folder of the run's batch, so a batch that is repeated after a failure leaves the same table, and
other streams' batches stay.  In strict mode a bad line stops the job; in lenient mode bad lines
are left out and, if ``rejects`` names a folder, kept there.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from velotrail.operators.latency import batch_latency
from velotrail.operators.parse import parse_line
from velotrail.sources.tables import BUCKETS, Latency, write_history, write_metrics, write_recent, write_rejects


def with_arrival(lines: DataFrame) -> DataFrame:
    """Stamp lines that have no arrival time with the clock of the micro-batch."""
    if "arrival_ms" in lines.columns:
        return lines
    return lines.withColumn("arrival_ms", F.unix_millis(F.current_timestamp()))


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval_ms: int = 2000,
    available_now: bool = False,
    output: str = "append",
) -> StreamingQuery:
    """Run ``sink(batch, batch_id)`` each ``interval_ms``, or over all that is there and stop.

    A batch without rows does no work.  A batch is read once, however often the sink goes over it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            if not held.isEmpty():
                sink(held, batch_id)
        finally:
            held.unpersist()

    writer = stream.writeStream.outputMode(output).foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{int(interval_ms)} milliseconds"}
    return writer.trigger(**trigger).start()


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a stream's checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]


def _keep_rejects(batch: DataFrame, batch_id: int, mode: str, path: str | None, run: str, split_key: bool = True) -> None:
    if mode == "lenient" and path:
        write_rejects(batch, path, split_key, run, batch_id)


def start_history(
    lines: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS, mode: str = "strict",
    rejects: str | None = None, metrics: str | None = None, now_ms: int | None = None, **when,
) -> StreamingQuery:
    """Each batch into the history table; ``metrics`` names a folder for its statistics, taken while it is written."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch.sparkSession, checkpoint)
        latency = Latency(now_ms) if metrics else None
        write_history(batch, path, buckets, mode, run, batch_id, latency)
        if latency:
            latency.save(batch.sparkSession, metrics, run, batch_id)
        _keep_rejects(batch, batch_id, mode, rejects, run, split_key=False)

    return start(with_arrival(lines), sink, checkpoint, **when)


def start_recent(
    lines: DataFrame, path: str, checkpoint: str, n: int = 1000, dedup: str = "line",
    buckets: int = BUCKETS, mode: str = "strict", parallelism: int | None = None,
    rejects: str | None = None, metrics: str | None = None, now_ms: int | None = None, **when,
) -> StreamingQuery:
    """Each batch adds at most ``n`` points per vehicle to a table that other jobs may write too; ``compact_recent`` trims it.

    For a set that is never larger than ``n`` see ``streaming.state``.  ``metrics`` as for the history.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch.sparkSession, checkpoint)
        spread = batch.repartition(parallelism) if parallelism else batch
        latency = Latency(now_ms) if metrics else None
        write_recent(spread, path, n, dedup, buckets, mode, run, batch_id, latency)
        if latency:
            latency.save(batch.sparkSession, metrics, run, batch_id)
        _keep_rejects(batch, batch_id, mode, rejects, run)

    return start(with_arrival(lines), sink, checkpoint, **when)


def start_latency(
    lines: DataFrame, path: str, checkpoint: str, now_ms: int | None = None, mode: str = "strict", **when
) -> StreamingQuery:
    """Per batch: count, total and average delay since sending, against the batch clock or ``now_ms``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_line(batch, mode=mode)
        track = parsed if mode == "strict" else parsed[0]
        now = now_ms if now_ms is not None else F.col("arrival_ms")
        write_metrics(batch_latency(track, now), path, run_of(batch.sparkSession, checkpoint), batch_id)

    return start(with_arrival(lines), sink, checkpoint, **when)
