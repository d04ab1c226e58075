"""Streaming jobs and sinks, run over the whole events table as a file stream.

Each run writes to new folders below the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from velotrail.operators import latency, parse
from velotrail.operators.history import HISTORY as HISTORY_COLUMNS
from velotrail.operators.recent import RECENT as RECENT_COLUMNS
from velotrail.plans.scratch import scratch_path
from velotrail.queries.inputs import (
    HISTORY, LINES, NOW_MS, RECENT, REPLAYED, TRACK, events_stream, lines, lines_of, with_,
)
from velotrail.queries.registry import ORACLES, query
from velotrail.sources import lines as src
from velotrail.sources import tables
from velotrail.streaming import jobs, state


def _stream(spark, sf):
    return lines_of(events_stream(spark, sf)).select("line", "arrival_ms")


def _stored(spark, sf):
    return lines(spark, sf).select("line", "arrival_ms")


def _later(df):
    return df.withColumn("arrival_ms", F.col("arrival_ms") + 1000)


def _finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _append(path):
    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return sink


def _landed(spark, path):
    return spark.read.schema("line string, arrival_ms bigint").parquet(path).select("line", "arrival_ms")


@query("src_track_lines", with_(LINES) + "SELECT line FROM lines")
def src_track_lines(spark, sf):
    """Lines written as text files, read back as a stream."""
    files, out, state = (scratch_path(spark, x) for x in ("lines", "landed", "state"))
    src.to_files(lines(spark, sf), files)
    stream = src.track_lines(spark, "text", files, maxFilesPerTrigger="1000")
    _finish(jobs.start(jobs.with_arrival(stream), _append(out), state, available_now=True))
    return _landed(spark, out).select("line")


@query("src_batch_interval", with_(LINES) + "SELECT line, arrival_ms FROM lines")
def src_batch_interval(spark, sf):
    """The same stream, run by the clock until all is read."""
    out, state = scratch_path(spark, "landed"), scratch_path(spark, "state")
    running = jobs.start(_stream(spark, sf), _append(out), state, interval_ms=200)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _landed(spark, out)


@query("src_skip_empty", with_(LINES) + "SELECT count(*) AS rows_seen, CAST(0 AS BIGINT) AS empty_batches FROM lines")
def src_skip_empty(spark, sf):
    """One stream whose batches have rows and one whose batches are empty: the sink sees the first only."""
    seen = {"full": 0, "none": 0}
    out = scratch_path(spark, "landed")

    def counting(name):
        def sink(batch, batch_id):
            seen[name] += 1
            _append(f"{out}/{name}")(batch, batch_id)

        return sink

    stream = _stream(spark, sf)
    _finish(jobs.start(stream, counting("full"), scratch_path(spark, "state"), available_now=True))
    nothing = stream.filter(F.col("line").isNull())
    _finish(jobs.start(nothing, counting("none"), scratch_path(spark, "state"), available_now=True))
    return _landed(spark, f"{out}/full").agg(F.count(F.lit(1)).alias("rows_seen")).withColumn(
        "empty_batches", F.lit(seen["none"]).cast("bigint"))


@query("sink_history", with_(REPLAYED, TRACK, HISTORY) + "SELECT * FROM history")
def sink_history(spark, sf):
    """Two batches of a run into the history table; the second repeats all lines a second later."""
    path = scratch_path(spark, "history")
    tables.write_history(_stored(spark, sf), path, buckets=8, run="a", batch_id=0)
    tables.write_history(_later(_stored(spark, sf)), path, buckets=8, run="a", batch_id=1)
    return tables.read_history(spark, path).select(*HISTORY_COLUMNS)


def _halves(spark, sf):
    """The stored lines in two parts."""
    every = _stored(spark, sf).withColumn("half", F.pmod(F.xxhash64("line"), F.lit(2)))
    return [every.filter(F.col("half") == k).drop("half") for k in (0, 1)]


@query("sink_history_two_runs", with_(LINES, TRACK, HISTORY) + "SELECT * FROM history")
def sink_history_two_runs(spark, sf):
    """Two calls and a stream into one table, with a settled copy in between; every row is kept."""
    path, (one, two) = scratch_path(spark, "history"), _halves(spark, sf)
    tables.write_history(one, path, buckets=8)
    tables.compact_history(spark, path, buckets=8)
    tables.write_history(two, path, buckets=8)
    _finish(jobs.start_history(_stream(spark, sf), path, scratch_path(spark, "state"), buckets=8, available_now=True))
    return tables.read_history(spark, path).select(*HISTORY_COLUMNS)


@query("sink_history_backfill", with_(LINES, TRACK, HISTORY) + "SELECT * FROM history")
def sink_history_backfill(spark, sf):
    """Batches 0 and 5 of a run, a settled copy of both, then batch 3; half of batch 0 comes again."""
    path = scratch_path(spark, "history")
    every = _stored(spark, sf).withColumn("third", F.pmod(F.xxhash64("line"), F.lit(3)))
    parts = [every.filter(F.col("third") == k).drop("third") for k in range(3)]
    tables.write_history(parts[0], path, buckets=8, run="day", batch_id=0)
    tables.write_history(parts[1], path, buckets=8, run="day", batch_id=5)
    tables.compact_history(spark, path, buckets=8, newest=True)
    tables.write_history(parts[2], path, buckets=8, run="day", batch_id=3)
    tables.write_history(parts[0].filter(F.pmod(F.xxhash64("line", F.lit(1)), F.lit(2)) == 0), path, buckets=8, run="day", batch_id=0)
    return tables.read_history(spark, path).select(*HISTORY_COLUMNS)


_TOP = """kept AS (SELECT vehicle_id, score, member, line, arrival_ms FROM recent
  QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY score DESC, member DESC) <= 5)"""


@query("sink_recent", with_(REPLAYED, TRACK, RECENT, _TOP) + "SELECT * FROM kept")
def sink_recent(spark, sf):
    path = scratch_path(spark, "recent")
    tables.write_recent(_stored(spark, sf), path, n=5, buckets=8, run="a", batch_id=0)
    tables.write_recent(_later(_stored(spark, sf)), path, n=5, buckets=8, run="a", batch_id=1)
    return tables.read_recent(spark, path, n=5).select(*RECENT_COLUMNS)


@query("sink_recent_two_runs", with_(LINES, TRACK, RECENT, _TOP) + "SELECT * FROM kept")
def sink_recent_two_runs(spark, sf):
    """Two calls into one table, with a settled copy in between."""
    path, (one, two) = scratch_path(spark, "recent"), _halves(spark, sf)
    tables.write_recent(one, path, n=5, buckets=8)
    tables.compact_recent(spark, path, n=5, buckets=8)
    tables.write_recent(two, path, n=5, buckets=8)
    return tables.read_recent(spark, path, n=5).select(*RECENT_COLUMNS)


@query("sink_topic", with_(LINES) + "SELECT line AS value FROM lines")
def sink_topic(spark, sf):
    """The records that ``to_topic`` sends, from a stream with a checkpoint into files.

    Spark's Kafka package is not there, so only the format differs; delivery to a broker is not shown.
    """
    path = scratch_path(spark, "topic")
    sent = src.message(_stream(spark, sf)).writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", scratch_path(spark, "state"))
    _finish(sent.trigger(availableNow=True).start())
    return spark.read.schema("value string").parquet(path)


_LATE = f"""CAST(sum({NOW_MS} - event_ms) AS DOUBLE) AS total_ms, CAST(sum({NOW_MS} - event_ms) AS DOUBLE) / count(*) AS avg_ms"""


@query("sink_metrics", with_(LINES, TRACK) + f"""
    SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n, {_LATE} FROM track UNION ALL SELECT 1, count(*), {_LATE} FROM track""")
def sink_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    statistics = latency.batch_latency(parse.parse_line(_stored(spark, sf)), NOW_MS)
    for batch_id in (0, 1):
        tables.write_metrics(statistics, path, "a", batch_id)
    return tables.read_metrics(spark, path).drop("run")


@query("st_history", with_(LINES, TRACK, HISTORY) + "SELECT * FROM history")
def st_history(spark, sf):
    path = scratch_path(spark, "history")
    _finish(jobs.start_history(_stream(spark, sf), path, scratch_path(spark, "state"), buckets=8, available_now=True))
    return tables.read_history(spark, path).select(*HISTORY_COLUMNS)


@query("st_recent", with_(LINES, TRACK, RECENT, _TOP) + "SELECT * FROM kept")
def st_recent(spark, sf):
    path = scratch_path(spark, "recent")
    _finish(jobs.start_recent(_stream(spark, sf), path, scratch_path(spark, "state"), n=5, buckets=8, available_now=True))
    return tables.read_recent(spark, path, n=5).select(*RECENT_COLUMNS)


@query("st_recent_state", with_(LINES, TRACK, RECENT, _TOP) + "SELECT * FROM kept")
def st_recent_state(spark, sf):
    """The sets as keyed state, read from the state store."""
    checkpoint = scratch_path(spark, "state")
    _finish(state.start_recent_state(_stream(spark, sf), checkpoint, n=5, available_now=True))
    return state.read_recent_state(spark, checkpoint, n=5).select(*RECENT_COLUMNS)


@query("st_history_metrics", with_(LINES, TRACK) + f"SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n, {_LATE} FROM track")
def st_history_metrics(spark, sf):
    """The statistics that come with the write of the history."""
    path, metrics = scratch_path(spark, "history"), scratch_path(spark, "metrics")
    _finish(jobs.start_history(_stream(spark, sf), path, scratch_path(spark, "state"), buckets=8, metrics=metrics, now_ms=NOW_MS, available_now=True))
    return tables.read_metrics(spark, metrics).drop("run")


@query("st_delay_report", ORACLES["delay_report"])
def st_delay_report(spark, sf):
    """The running report of a stream."""
    path = scratch_path(spark, "delays")
    _finish(state.start_delay_report(_stream(spark, sf), path, scratch_path(spark, "state"), NOW_MS, every=20, available_now=True))
    return state.read_delay_report(spark, path)


@query("st_progress_marks", ORACLES["progress_marks_by_vehicle"])
def st_progress_marks(spark, sf):
    path = scratch_path(spark, "marks")
    _finish(state.start_progress_marks(_stream(spark, sf), path, scratch_path(spark, "state"), every=10, available_now=True))
    return state.read_progress_marks(spark, path)


@query("st_latency", with_(LINES, TRACK) + f"SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n, {_LATE} FROM track")
def st_latency(spark, sf):
    path = scratch_path(spark, "metrics")
    _finish(jobs.start_latency(_stream(spark, sf), path, scratch_path(spark, "state"), now_ms=NOW_MS, available_now=True))
    return tables.read_metrics(spark, path).drop("run")
