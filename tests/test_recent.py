import pytest
from pyspark.sql import functions as F

from helpers import rows
from velotrail.operators import parse, recent
from velotrail.sources import tables

BODY = "116.1,40.1,10,20"


def lines(spark, *pairs):
    return spark.createDataFrame(list(pairs), "line string, arrival_ms bigint")


def members(spark, *pairs, dedup="line"):
    return recent.recent_set(parse.parse_line(lines(spark, *pairs)), dedup)


def points(spark, count, vehicle="a"):
    return members(spark, *[(f"{vehicle}@{t},{BODY}", t + 5) for t in range(count)])


def test_dedup(spark):
    twice = [(f"a@5,{BODY}", 100), (f"a@5,{BODY}", 200), (f"a@5,{BODY}", 200)]
    assert rows(members(spark, *twice), "member") == [(f"a@5,{BODY}@100",)]
    assert rows(members(spark, *twice, dedup="member"), "member") == [(f"a@5,{BODY}@100",), (f"a@5,{BODY}@200",)]
    with pytest.raises(ValueError):
        members(spark, *twice, dedup="time")


def test_score_keeps_the_fraction_and_the_time_its_text(spark):
    track = parse.parse_line(lines(spark, (f"a@07.5,{BODY}", 1)))
    assert recent.recent_set(track).first().score == 7.5 and track.first().event_ms == 7
    assert parse.keyed_by_time(track).first().timed_line == f"07.5@a@07.5,{BODY}"
    assert parse.score(track).first().score == 7.5


def test_same_time_other_payload_is_another_member(spark):
    both = members(spark, ("a@5,2,2,3,4", 1), ("a@5,1,2,3,4", 1))
    assert [r.line for r in recent.recent_track(both, ["a"]).collect()] == ["a@5,1,2,3,4", "a@5,2,2,3,4"]


@pytest.mark.parametrize("hot_rows", [None, 2])
@pytest.mark.parametrize("n,left", [(5, 5), (10, 7)])
def test_keep_last_n(spark, n, left, hot_rows):
    seven = points(spark, 7)
    kept = recent.keep_last_n(seven, n, hot_rows=hot_rows)
    assert kept.count() == left and kept.agg(F.max("score")).first()[0] == 6.0
    assert rows(recent.keep_last_n(kept, n, hot_rows=hot_rows)) == rows(kept)
    gone = recent.trimmed_rows(seven, n, hot_rows=hot_rows)
    assert rows(kept.unionByName(gone)) == rows(seven)


@pytest.mark.parametrize("hot_rows", [None, 2])
@pytest.mark.parametrize("first,last", [(0, -1), (0, 0), (-1, -1), (2, 4), (-3, 5), (5, 2), (-100, 100), (3, -3), (9, 12)])
def test_rank_range(spark, first, last, hot_rows):
    size = 7
    low = first if first >= 0 else max(size + first, 0)
    high = last if last >= 0 else size + last
    want = [float(i) for i in range(size) if low <= i <= high]
    got = recent.rank_range(points(spark, size), first, last, hot_rows=hot_rows)
    assert sorted(r.score for r in got.collect()) == want


def test_latest_and_sizes(spark):
    both = points(spark, 3, "a").unionByName(points(spark, 2, "b"))
    assert rows(recent.latest_position(both), "vehicle_id", "score") == [("a", 2.0), ("b", 1.0)]
    assert rows(recent.set_size(both)) == [("a", 3), ("b", 2)]
    assert rows(recent.set_keys(both)) == [("info_a",), ("info_b",)]


@pytest.mark.parametrize("count,n", [(3, 10), (10, 3), (9, 3), (1, 1), (0, 4)])
def test_key_slices(spark, count, n):
    keys = spark.range(count).select(F.format_string("info_%03d", "id").alias("set_name"))
    size = count // n
    want = [(f"info_{i:03d}", min(i // size, n - 1) if size else n - 1) for i in range(count)]
    assert rows(recent.key_slices(keys, n)) == want


def test_batches_in_any_order_give_one_set(spark, tmp_path):
    batches = [lines(spark, *[(f"{v}@{t},{BODY}", t + 100 * i) for v in "ab" for t in span])
               for i, span in enumerate([range(0, 6), range(4, 12), range(2, 8)])]
    results = []
    for name, order in (("x", [0, 1, 2]), ("y", [2, 1, 0])):
        path = str(tmp_path / name)
        for batch_id in order:
            tables.write_recent(batches[batch_id], path, n=4, buckets=2, run="r", batch_id=batch_id)
        tables.write_recent(batches[1], path, n=4, buckets=2, run="r", batch_id=1)
        results.append(rows(tables.read_recent(spark, path, n=4)))
    whole = recent.recent_set(parse.parse_line(batches[0].unionByName(batches[1]).unionByName(batches[2])))
    assert results[0] == results[1] == rows(recent.keep_last_n(whole, 4), "vehicle_id", "score", "member", "line", "arrival_ms")
    path = str(tmp_path / "x")
    assert tables.compact_recent(spark, path, n=4, buckets=2, newest=True)
    assert rows(tables.read_recent(spark, path, n=4)) == results[0]
    assert rows(tables.read_recent(spark, path, n=4, settled=True)) == results[0]
    tables.write_recent(lines(spark, (f"c@1,{BODY}", 1)), path, n=4, buckets=2)
    tables.write_recent(lines(spark, (f"c@2,{BODY}", 1)), path, n=4, buckets=2)
    assert tables.read_recent(spark, path, n=4).count() == len(results[0]) + 2
    assert tables.read_recent(spark, str(tmp_path / "none")).count() == 0
