"""Streams of text files: after all batches the tables equal the batch operators."""

import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import rows
from velotrail.operators import history as hist
from velotrail.operators import parse, recent
from velotrail.sources import lines as src
from velotrail.sources import tables
from velotrail.streaming import jobs

BODY = "116.1,40.1,10,20"
SCHEMA = "line string, arrival_ms bigint"


@pytest.fixture
def feed(spark, tmp_path):
    """A folder that gets one parquet file per batch."""
    folder = tmp_path / "in"
    folder.mkdir()
    state = {"n": 0}

    def add(*pairs):
        state["n"] += 1
        spark.createDataFrame(list(pairs), SCHEMA).toPandas().to_parquet(folder / f"{state['n']:03d}.parquet")
        stamp = 1_700_000_000 + state["n"]
        os.utime(folder / f"{state['n']:03d}.parquet", (stamp, stamp))

    def stream():
        return src.track_lines(spark, "parquet", str(folder), schema=SCHEMA, maxFilesPerTrigger="1")

    add.stream, add.folder = stream, str(folder)
    return add


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def points(vehicles, times, arrival=0):
    return [(f"{v}@{t},{BODY}", t + arrival) for v in vehicles for t in times]


def test_history_equals_batch_after_restart_and_replay(spark, tmp_path, feed):
    path, state = str(tmp_path / "h"), str(tmp_path / "s")
    feed(*points("abc", range(5)))
    feed(*points("bc", range(3, 9), 50))
    finish(jobs.start_history(feed.stream(), path, state, buckets=2, available_now=True))
    (run,) = os.listdir(os.path.join(path, "live"))
    assert sorted(os.listdir(os.path.join(path, "live", run))) == ["batch_id=0", "batch_id=1"]
    feed(*points("ad", range(20, 25)))
    finish(jobs.start_history(feed.stream(), path, state, buckets=2, available_now=True))
    stored = spark.read.schema(SCHEMA).parquet(feed.folder)
    want = hist.newest_rows(hist.history_rows(stored))
    got = tables.read_history(spark, path)
    assert rows(got, *hist.HISTORY) == rows(want, *hist.HISTORY)
    # A new checkpoint repeats every batch.
    finish(jobs.start_history(feed.stream(), path, str(tmp_path / "s2"), buckets=2, available_now=True))
    assert rows(tables.read_history(spark, path), *hist.HISTORY) == rows(want, *hist.HISTORY)


def test_recent_equals_batch(spark, tmp_path, feed):
    path = str(tmp_path / "r")
    feed(*points("ab", range(4)))
    feed(*points("ab", range(2, 9), 50))
    feed(*points("b", range(1), 900))
    finish(jobs.start_recent(feed.stream(), path, str(tmp_path / "s"), n=4, buckets=2, parallelism=3, available_now=True))
    stored = spark.read.schema(SCHEMA).parquet(feed.folder)
    want = recent.keep_last_n(recent.recent_set(parse.parse_line(stored)), 4)
    got = tables.read_recent(spark, path, n=4)
    assert rows(got, *recent.RECENT) == rows(want, *recent.RECENT)


def test_latency_per_batch(spark, tmp_path, feed):
    path = str(tmp_path / "m")
    feed(*points("a", [10, 20]))
    feed(*points("a", [40]))
    finish(jobs.start_latency(feed.stream(), path, str(tmp_path / "s"), now_ms=100, available_now=True))
    assert rows(tables.read_metrics(spark, path), "batch_id", "n", "total_ms", "avg_ms") == [(0, 2, 170.0, 85.0), (1, 1, 60.0, 60.0)]


def jobs_of(spark, group, work):
    """Number of Spark jobs that ``work`` runs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_statistics_come_with_the_write(spark, tmp_path, feed):
    feed(*points("ab", [10, 20], 5))
    feed((f"a@40,{BODY}", 41), ("broken", 1))
    for name, job, now, want in (("h", jobs.start_history, 100, [(0, 4, 340.0, 85.0), (1, 1, 60.0, 60.0)]),
                                 ("r", jobs.start_recent, None, [(0, 4, 20.0, 5.0), (1, 1, 1.0, 1.0)])):
        metrics = str(tmp_path / f"{name}m")
        finish(job(feed.stream(), str(tmp_path / name), str(tmp_path / f"{name}s"), mode="lenient", buckets=2, metrics=metrics, now_ms=now, available_now=True))
        assert rows(tables.read_metrics(spark, metrics), "batch_id", "n", "total_ms", "avg_ms") == want
    lines = spark.createDataFrame(points("ab", range(5)), SCHEMA)
    plain = jobs_of(spark, "plain", lambda: tables.write_history(lines, str(tmp_path / "p1"), 2))
    assert jobs_of(spark, "watched", lambda: tables.write_history(lines, str(tmp_path / "p2"), 2, latency=tables.Latency(9))) == plain


def test_strict_stream_fails_and_lenient_goes_on(spark, tmp_path, feed):
    feed((f"a@1,{BODY}", 1), ("broken", 1), (f"a@2,{BODY}", 1))
    strict = jobs.start_history(feed.stream(), str(tmp_path / "h1"), str(tmp_path / "s1"), available_now=True)
    with pytest.raises(Exception, match="bad track line"):
        strict.awaitTermination(120)
    path = str(tmp_path / "h2")
    finish(jobs.start_history(feed.stream(), path, str(tmp_path / "s2"), mode="lenient",
                              rejects=str(tmp_path / "bad"), available_now=True))
    assert rows(tables.read_history(spark, path), "row_key") == [("a@1",), ("a@2",)]
    assert rows(tables.read_rejects(spark, str(tmp_path / "bad")).drop("run")) == [("broken", "bad_field_count", 0)]
    finish(jobs.start_recent(feed.stream(), str(tmp_path / "r"), str(tmp_path / "s3"), mode="lenient",
                             rejects=str(tmp_path / "bad2"), available_now=True))
    assert rows(tables.read_rejects(spark, str(tmp_path / "bad2")).drop("run")) == [("broken", "bad_field_count", 0)]


def test_empty_batch_does_no_work(spark, tmp_path, feed):
    feed(*points("a", [1]))
    path = str(tmp_path / "h")
    nothing = feed.stream().filter("arrival_ms < 0")
    finish(jobs.start_history(nothing, path, str(tmp_path / "s"), available_now=True))
    assert not os.path.exists(path)


def test_text_source_is_stamped_with_the_batch_clock(spark, tmp_path):
    folder = tmp_path / "text"
    src.to_files(spark.createDataFrame([(f"a@{t},{BODY}",) for t in range(3)], "line string"), str(folder))
    before = int(time.time() * 1000)
    path = str(tmp_path / "h")
    finish(jobs.start_history(src.track_lines(spark, "text", str(folder)), path, str(tmp_path / "s"), available_now=True))
    stamps = {r.arrival_ms for r in tables.read_history(spark, path).collect()}
    assert len(stamps) == 1 and stamps.pop() >= before


def test_batch_reads_of_the_same_source(spark, tmp_path):
    folder = str(tmp_path / "text")
    lines = spark.createDataFrame([(f"a@{t},{BODY}",) for t in range(3)], "line string")
    src.to_files(lines, folder)
    assert rows(src.track_lines(spark, "text", folder, stream=False)) == rows(lines)


def test_clock_trigger(spark, tmp_path, feed):
    feed(*points("a", [1, 2]))
    path = str(tmp_path / "h")
    query = jobs.start_history(feed.stream(), path, str(tmp_path / "s"), interval_ms=100)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert tables.read_history(spark, path).count() == 2


def test_source_options():
    options = src.topic_options("host:9092", "bicycle_track", maxOffsetsPerTrigger="10")
    assert options["subscribe"] == "bicycle_track" and options["maxOffsetsPerTrigger"] == "10"


def test_source_arguments(spark, tmp_path):
    with pytest.raises(ValueError):
        src.track_lines(spark, "socket", "x")
    with pytest.raises(ValueError):
        src.track_lines(spark, "kafka", "host:9092")
    with pytest.raises(ValueError):
        src.to_topic(src.track_lines(spark, "text", str(tmp_path)), "host:9092", "t")


def test_topic_sink_arguments(spark, tmp_path, monkeypatch):
    """What a topic gets and how, without a broker: a batch write, and a stream with its checkpoint."""
    from unittest.mock import MagicMock

    for streaming in (False, True):
        lines, sent = MagicMock(isStreaming=streaming), MagicMock()
        monkeypatch.setattr(src, "message", lambda given, lines=lines, sent=sent: sent if given is lines else None)
        src.to_topic(lines, "host:9092", "bicycle_track", "/state" if streaming else None)
        writer = sent.writeStream if streaming else sent.write
        writer.format.assert_called_once_with("kafka")
        options = writer.format.return_value.options
        options.assert_called_once_with(**{"kafka.bootstrap.servers": "host:9092", "topic": "bicycle_track"})
        if streaming:
            options.return_value.option.assert_called_once_with("checkpointLocation", "/state")
            options.return_value.option.return_value.start.assert_called_once_with()
        else:
            options.return_value.save.assert_called_once_with()
    monkeypatch.undo()
    assert src.message(spark.createDataFrame([("a", 1)], "line string, x int")).collect()[0].asDict() == {"value": "a"}


def test_union_of_streams(spark, tmp_path, feed):
    from velotrail.operators.distribute import union_sources

    feed(*points("a", [1, 2]))
    both = union_sources(feed.stream(), feed.stream().withColumn("arrival_ms", F.col("arrival_ms") + 5))
    path = str(tmp_path / "r")
    finish(jobs.start_recent(both, path, str(tmp_path / "s"), n=10, dedup="member", available_now=True))
    assert tables.read_recent(spark, path, n=10, dedup="member").count() == 4


def test_streams_into_one_table_keep_each_others_rows(spark, tmp_path, feed):
    path = str(tmp_path / "h")
    feed(*points("a", [1, 2]))
    finish(jobs.start_history(feed.stream(), path, str(tmp_path / "s1"), buckets=2, available_now=True))
    for file in os.listdir(feed.folder):
        os.unlink(os.path.join(feed.folder, file))
    feed(*points("b", [1]))
    finish(jobs.start_history(feed.stream(), path, str(tmp_path / "s2"), buckets=2, available_now=True))
    assert rows(tables.read_history(spark, path), "row_key") == [("a@1",), ("a@2",), ("b@1",)]
    finish(jobs.start_recent(feed.stream(), str(tmp_path / "r"), str(tmp_path / "s3"), available_now=True))
    finish(jobs.start_latency(feed.stream(), str(tmp_path / "m"), str(tmp_path / "s4"), now_ms=9, available_now=True))
    finish(jobs.start_latency(feed.stream(), str(tmp_path / "m"), str(tmp_path / "s5"), now_ms=9, available_now=True))
    assert tables.read_metrics(spark, str(tmp_path / "m")).count() == 2


STREAMED = ("src_batch_interval", "src_skip_empty", "st_history", "st_recent", "st_latency")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
@pytest.mark.parametrize("name", STREAMED)
def test_stream_queries_read_a_table_of_several_files(spark, tmp_path, name):
    from velotrail.queries import QUERIES

    whole = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    whole.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    assert rows(QUERIES[name](spark, str(tmp_path))) == rows(QUERIES[name](spark, "/root/testdata/sf0.001"))
