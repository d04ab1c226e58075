"""Recent sets as keyed state."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from test_streaming import BODY, SCHEMA, feed, finish, points  # noqa: F401 (a fixture)
from velotrail.operators import latency, parse, recent
from velotrail.streaming import state


def batch_sets(spark, folder, n, dedup="line"):
    stored = spark.read.schema(SCHEMA).parquet(folder)
    return rows(recent.keep_last_n(recent.recent_set(parse.parse_line(stored), dedup), n), *recent.RECENT)


def held(spark, checkpoint):
    found = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "members").load()
    return Counter(r.vehicle_id for r in found.select("key.vehicle_id").collect())


def test_many_batches_hold_at_most_n(spark, tmp_path, feed):  # noqa: F811
    """50 batches with replays, late points and earlier arrivals; a restart in between."""
    checkpoint, rng, sizes = str(tmp_path / "s"), random.Random(3), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")

    def changed(batch, batch_id):
        sizes.extend(r.held for r in batch.collect())

    try:
        for part in range(2):
            for _ in range(25):
                feed(*points(rng.choice(["a", "ab", "c"]), [rng.randrange(40) for _ in range(6)], rng.randrange(100)))
            finish(state.start_recent_state(feed.stream(), checkpoint, n=7, changed=changed, available_now=True))
            got = state.read_recent_state(spark, checkpoint, 7)
            assert rows(got, *recent.RECENT) == batch_sets(spark, feed.folder, 7)
            assert max(held(spark, checkpoint).values()) == 7
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) >= 50 and max(sizes) == 7
    assert rows(state.read_recent_state(spark, checkpoint, 2), *recent.RECENT) == batch_sets(spark, feed.folder, 2)
    # A batch before the last one is still there.
    assert state.read_recent_state(spark, checkpoint, 7, batch_id=48).count() > 0


@pytest.mark.parametrize("dedup", ["line", "member"])
def test_pieces_are_merged_on_reading(spark, tmp_path, feed, monkeypatch, dedup):  # noqa: F811
    monkeypatch.setattr(state, "GATHERED", 20)
    checkpoint = str(tmp_path / "s")
    feed(*points("a", range(60)), *points("b", range(3)))
    feed(*points("a", range(50, 90), 5))
    feed(*points("ab", range(85), 1))
    finish(state.start_recent_state(feed.stream(), checkpoint, n=5, dedup=dedup, pieces=4, available_now=True))
    assert rows(state.read_recent_state(spark, checkpoint, 5), *recent.RECENT) == batch_sets(spark, feed.folder, 5, dedup)
    assert max(held(spark, checkpoint).values()) <= 20


def test_lenient_and_bad_arguments(spark, tmp_path, feed):  # noqa: F811
    feed((f"a@1,{BODY}", 1), ("broken", 1))
    checkpoint = str(tmp_path / "s")
    finish(state.start_recent_state(feed.stream(), checkpoint, n=5, mode="lenient", available_now=True))
    assert rows(state.read_recent_state(spark, checkpoint), "line") == [(f"a@1,{BODY}",)]
    with pytest.raises(ValueError):
        state.start_recent_state(feed.stream(), checkpoint, dedup="none")
    strict = state.start_recent_state(feed.stream(), str(tmp_path / "s2"), n=5, available_now=True)
    with pytest.raises(Exception, match="bad track line"):
        strict.awaitTermination(120)


def test_ties_by_bytes_and_first_arrival():
    old = [(1.0, "a", 5), (1.0, "aé", 5)]
    assert state.merged(iter(old), iter([(1.0, "a", 3), (0.0, "z", 1), (1.0, "ab", 9)]), 3, "line") == [(1.0, "a", 3), (1.0, "ab", 9), (1.0, "aé", 5)]
    assert len(state.merged(iter(old), iter([(1.0, "a", 3)]), 9, "member")) == 3


def test_settings_are_as_before(spark, tmp_path, feed):  # noqa: F811
    feed(*points("a", [1]))
    before = spark.conf.get(state.PROVIDER)
    finish(state.start_recent_state(feed.stream(), str(tmp_path / "s"), available_now=True))
    assert spark.conf.get(state.PROVIDER) == before
    assert state.read_recent_state(spark, str(tmp_path / "s")).filter(F.col("vehicle_id") == "a").count() == 1


def test_running_reports_equal_the_batch_reports(spark, tmp_path, feed):  # noqa: F811
    """Batches in order of arrival, of any size, with a restart; late events and equal arrivals."""
    rng, lines, at = random.Random(8), [], 0
    for k in range(160):
        at += rng.randrange(3)
        lines.append((f"{rng.choice('aab')}@{at - rng.randrange(-5, 40)},{BODY[:-1]}{k % 10}", at))
    cuts = sorted({*(rng.randrange(160) for _ in range(7)), 0, 160})
    cuts = [0, *[c for c in cuts if 0 < c < 160 and lines[c][1] != lines[c - 1][1]], 160]  # equal arrivals come in one batch
    jobs = {"delays": lambda: state.start_delay_report(feed.stream(), str(tmp_path / "d"), str(tmp_path / "ds"), 500, every=7, available_now=True),
            "marks": lambda: state.start_progress_marks(feed.stream(), str(tmp_path / "m"), str(tmp_path / "ms"), every=9, available_now=True)}
    for a, b in zip(cuts, cuts[1:], strict=False):
        feed(*lines[a:b])
        if a in (cuts[2], cuts[-2]):
            for job in jobs.values():
                finish(job())
    track = parse.parse_line(spark.read.schema(SCHEMA).parquet(feed.folder))
    want = latency.delay_report(track, 500, every=7)
    assert rows(state.read_delay_report(spark, str(tmp_path / "d")), *want.columns) == rows(want) and want.count() > 15
    marks = latency.progress_marks(track, every=9, by="vehicle_id")
    assert rows(state.read_progress_marks(spark, str(tmp_path / "m")), *marks.columns) == rows(marks)
    assert state.read_delay_report(spark, str(tmp_path / "none")).count() == 0
