import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from velotrail.operators import history as hist
from velotrail.operators.cells import scan_range
from velotrail.plans import skew
from velotrail.sources import tables

BODY = "116.1,40.1,10,20"


def stamped(spark, *pairs):
    return spark.createDataFrame(list(pairs), "line string, arrival_ms bigint")


def test_replayed_line_keeps_the_later_arrival(spark):
    lines = stamped(spark, (f"1000001@5,{BODY}", 100), (f"1000001@5,{BODY}", 200))
    assert rows(hist.newest_rows(hist.history_rows(lines)), "row_key", "arrival_ms") == [("1000001@5", 200)]


def test_equal_arrivals_are_settled_by_the_line(spark):
    lines = stamped(spark, ("1@5,1,2,3,4", 100), ("1@5,1,2,3,5", 100), ("1@5,0,2,3,9", 99))
    assert rows(hist.newest_rows(hist.history_rows(lines)), "longitude", "velocity") == [("1", "5")]


def test_key_without_time_is_stored(spark):
    lines = stamped(spark, (f"1000001,{BODY}", 1), (f"1@2@3,{BODY}", 1))
    stored = hist.newest_rows(hist.history_rows(lines))
    assert rows(stored, "row_key", "vehicle_id", "event_ms") == [("1000001", "1000001", None), ("1@2@3", "1", 2)]


def test_exact_and_byte_ranges(spark):
    keys = ["1000001@5", "10000020@5", "1000002@1", "9@5", "10@7"]
    stored = hist.newest_rows(hist.history_rows(stamped(spark, *[(f"{k},{BODY}", 1) for k in keys])))

    def found(i, mode):
        return [r.row_key for r in hist.track_history(stored, [i], mode).collect()]

    assert found("1000001", "exact") == ["1000001@5"]
    assert found("1000001", "bytes") == ["1000001@5", "10000020@5"]
    assert found("9", "exact") == ["9@5"]
    assert found("9", "bytes") == []
    low, high = hist.byte_range("1000001")
    assert rows(scan_range(stored, low, high), "row_key") == [("1000001@5",), ("10000020@5",)]


def test_many_vehicles_in_request_order(spark):
    stored = hist.newest_rows(hist.history_rows(stamped(spark, *[(f"{v}@{t},{BODY}", 1) for v in "abc" for t in (2, 1)])))
    ids = spark.createDataFrame([(0, "c"), (1, "a"), (2, "zz"), (3, "c")], "pos int, vehicle_id string")
    got = [(r.pos, r.row_key) for r in hist.track_history(stored, ids).collect()]
    assert got == [(0, "c@1"), (0, "c@2"), (1, "a@1"), (1, "a@2"), (3, "c@1"), (3, "c@2")]
    with pytest.raises(ValueError):
        hist.track_history(stored, ids, mode="some")


@pytest.mark.parametrize("large", [False, True])
def test_byte_ranges_of_many_vehicles(spark, large, monkeypatch):
    if large:
        monkeypatch.setattr(skew, "SMALL_ROWS", 0)
        monkeypatch.setattr(skew, "HOT_ROWS", 2)
    keys = [f"{v}@{t}" for v in (1, 2, 9, 10, 11, 19, 20, 21, 99, 100, 101, 109, 110, 199, 200, "1:", "19:", "0", "007", "08", "x")
            for t in ("000000", "0000000", "5", "")] + ["1", "10", "2", "20", "19"]
    stored = hist.newest_rows(hist.history_rows(stamped(spark, *[(f"{k},{BODY}", 1) for k in keys])))
    wanted = ["1", "2", "9", "10", "19", "99", "100", "109", "199", "007", "0099", "5", "1"]
    ids = spark.createDataFrame(list(enumerate(wanted)), "pos int, vehicle_id string")
    got = [(r.pos, r.row_key) for r in hist.track_history(stored, ids, mode="bytes").collect()]
    want = [(i, k) for i, v in enumerate(wanted) for k in sorted(set(keys)) if hist.byte_range(v)[0] <= k < hist.byte_range(v)[1]]
    assert got == want
    for i, v in enumerate(wanted):
        assert [r.row_key for r in hist.track_history(stored, [v], mode="bytes").collect()] == [k for j, k in want if j == i]
    none = spark.createDataFrame([(0, "9")], "pos int, vehicle_id string")
    assert hist.track_history(stored, none, mode="bytes").count() == 0


def test_pages_until_empty_equal_all_pages_at_once(spark):
    keys = spark.range(23).select(F.format_string("k%03d", "id").alias("row_key"))
    seen, last = [], None
    while True:
        block = [r.row_key for r in hist.page(keys, 5, last).collect()]
        if not block:
            break
        seen.append(block)
        last = block[-1]
    numbered = sorted((r.page_no, r.row_key) for r in hist.page_numbers(keys, 5).collect())
    assert numbered == [(i, k) for i, block in enumerate(seen) for k in block]


def test_a_page_settles_only_its_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    for k in range(2):
        tables.write_history(stamped(spark, *[(f"v{i:03d}@1,{BODY}", k) for i in range(300)]), path, buckets=2)
    found = hist.page(tables.read_history(spark, path), 5, "v100@1")
    assert [r.row_key for r in found.collect()] == [f"v{i}@1" for i in range(101, 106)]
    assert "LessThanOrEqual(row_key,v105@1)" in plan(found) and "GreaterThan(row_key,v100@1)" in plan(found)


def test_byte_ranges_equal_every_pair(spark):
    rng = random.Random(4)
    keys = {"".join(rng.choice("01289@:/-a") for _ in range(rng.randrange(8))) for _ in range(1500)}
    keys |= {f"{i}@{t}" for i in range(95, 130) for t in ("000000", "5", "/")} | {f"{i}" for i in range(0, 130)}
    ids = [str(i) for i in range(1, 130)] + ["007", "0", "10", "1999", "9999"]
    history = spark.createDataFrame([(k,) for k in sorted(keys)], "row_key string")
    asked = spark.createDataFrame(list(enumerate(ids)), "pos int, vehicle_id string")
    want = []
    for pos, i in enumerate(ids):
        low, high = hist.byte_range(i)
        want += [(pos, k) for k in keys if low <= k < high]
    assert len(want) > 200
    assert rows(hist.track_history(history, asked, mode="bytes"), "pos", "row_key") == sorted(want, key=repr)


def test_last_of_first_n_is_not_the_newest(spark):
    stored = hist.newest_rows(hist.history_rows(stamped(spark, *[(f"a@{t},{BODY}", 1) for t in range(10, 20)])))
    assert rows(hist.last_of_first_n(stored, 3), "vehicle_id", "row_key") == [("a", "a@12")]
    assert rows(hist.last_of_first_n(stored, 100), "vehicle_id", "row_key") == [("a", "a@19")]


def test_table_of_batches(spark, tmp_path):
    path = str(tmp_path / "h")
    assert tables.read_history(spark, path).count() == 0
    assert not tables.compact_history(spark, path)
    first = stamped(spark, *[(f"{v}@{t},{BODY}", 10) for v in "abcdef" for t in range(20)])
    again = first.withColumn("arrival_ms", F.lit(20).cast("bigint"))
    tables.write_history(first, path, 4, run="r", batch_id=0)
    once = rows(tables.read_history(spark, path))
    tables.write_history(first, path, 4, run="r", batch_id=0)
    assert rows(tables.read_history(spark, path)) == once and len(once) == 120
    tables.write_history(again.filter("line like 'a@%'"), path, 4, run="r", batch_id=1)
    both = tables.read_history(spark, path)
    assert both.filter("arrival_ms = 20").count() == 20 and both.count() == 120


def live_batches(spark, path):
    """The batches that a read of the table takes besides the settled copy."""
    return list(tables.snapshot(spark, path).batches)


def test_calls_without_a_run_keep_every_row(spark, tmp_path):
    path = str(tmp_path / "h")
    tables.write_history(stamped(spark, (f"1@100,{BODY}", 1)), path, 2)
    tables.write_history(stamped(spark, (f"2@100,{BODY}", 1)), path, 2)
    assert rows(tables.read_history(spark, path), "row_key") == [("1@100",), ("2@100",)]
    for line in ("bad", "worse"):
        tables.write_rejects(stamped(spark, (line, 1)), path + "-rejects")
    assert rows(tables.read_rejects(spark, path + "-rejects"), "line") == [("bad",), ("worse",)]
    assert tables.read_rejects(spark, path + "-none").count() == tables.read_metrics(spark, path + "-none").count() == 0


def test_settled_copies_replace_their_batches(spark, tmp_path):
    path = str(tmp_path / "h")
    first = stamped(spark, *[(f"{v}@{t},{BODY}", 10) for v in "abcdef" for t in range(20)])
    later = first.filter("line like 'a@%'").withColumn("arrival_ms", F.lit(20).cast("bigint"))
    for batch_id in (0, 1):
        tables.write_history(first, path, 4, run="r", batch_id=batch_id)
    tables.write_history(later, path, 4)
    want = rows(tables.read_history(spark, path))
    assert tables.compact_history(spark, path, 4)
    assert rows(tables.read_history(spark, path)) == want
    # The run's newest batch may still be written.
    assert live_batches(spark, path) == [("r", 1)]
    assert not tables.compact_history(spark, path, 4)
    assert tables.compact_history(spark, path, 4, newest=True)
    assert live_batches(spark, path) == []
    plain = tables.read_history(spark, path, settled=True)
    assert rows(plain, *tables.read_history(spark, path).columns) == want and "Exchange" not in plan(plain)
    tables.write_history(later.withColumn("arrival_ms", F.lit(30).cast("bigint")), path, 4)
    assert len(live_batches(spark, path)) == 1
    assert tables.read_history(spark, path).filter("arrival_ms = 30").count() == 20


def keys(frame):
    return sorted(r.row_key for r in frame.collect())


def test_a_batch_may_come_late_or_again(spark, tmp_path):
    """Batches 0 and 5, a copy of both, then batch 3, then batch 0 with another row; names may hold any characters."""
    path, run = str(tmp_path / "h"), "day 1/~%a"
    for batch_id in (0, 5):
        tables.write_history(stamped(spark, (f"1@{batch_id}00,{BODY}", 1)), path, 2, run=run, batch_id=batch_id)
    assert tables.compact_history(spark, path, 2, newest=True)
    assert live_batches(spark, path) == []
    tables.write_history(stamped(spark, (f"1@300,{BODY}", 1)), path, 2, run=run, batch_id=3)
    assert keys(tables.read_history(spark, path)) == ["1@000", "1@300", "1@500"]
    tables.write_history(stamped(spark, (f"1@700,{BODY}", 1)), path, 2, run=run, batch_id=0)
    assert live_batches(spark, path) == [(run, 0), (run, 3)]
    for _ in range(2):
        assert keys(tables.read_history(spark, path)) == ["1@000", "1@300", "1@500", "1@700"]
        tables.compact_history(spark, path, 2, newest=True)
    # A batch that is in no copy yet is replaced.
    for n in (1, 2):
        tables.write_history(stamped(spark, (f"2@{n},{BODY}", 1)), path, 2, run=run, batch_id=9)
    assert keys(tables.read_history(spark, path))[-1] == "2@2" and len(keys(tables.read_history(spark, path))) == 5


def test_snapshots_hold_still(spark, tmp_path):
    """Pages read around new batches and copies equal one scan."""
    path = str(tmp_path / "h")
    for k in range(3):
        tables.write_history(stamped(spark, *[(f"{v}@{k * 10 + t},{BODY}", 1) for v in "ab" for t in range(5)]), path, 2, run="r", batch_id=k)
    tables.compact_history(spark, path, 2)
    at = tables.snapshot(spark, path)
    want, seen, last, n = keys(tables.read_history(spark, path)), [], None, 0
    while True:
        block = [r.row_key for r in hist.page(tables.read_history(spark, path, at=at), 7, last).collect()]
        if not block:
            break
        seen, last, n = seen + block, block[-1], n + 1
        tables.write_history(stamped(spark, *[(f"{v}@{n},{BODY}", 9) for v in "abc"]), path, 2, run="r", batch_id=10 + n)
        tables.compact_history(spark, path, 2, newest=n % 2 == 0)
    assert seen == want and len(keys(tables.read_history(spark, path))) > len(want)


def test_clean_tables_keep_every_row(spark, tmp_path):
    path = str(tmp_path / "h")
    for k in range(3):
        tables.write_history(stamped(spark, (f"{k}@1,{BODY}", 1)), path, 2, run="r", batch_id=k)
        tables.write_history(stamped(spark, (f"c{k}@1,{BODY}", 1)), path, 2)
        tables.compact_history(spark, path, 2)
    tables.write_history(stamped(spark, (f"late@1,{BODY}", 1)), path, 2, run="r", batch_id=0)
    want = keys(tables.read_history(spark, path))
    assert tables.clean_table(spark, path) == 4  # r 1 and the three calls; r 0 is there again, r 2 in no copy yet
    assert keys(tables.read_history(spark, path)) == want and len(want) == 7
    assert len(glob.glob(f"{path}/settled/*")) == 1 and len(glob.glob(f"{path}/live/*/*")) == 2
    assert tables.clean_table(spark, path) == 0
    assert tables.clean_table(spark, path + "-none") == 0


def test_reads_do_not_grow_with_past_calls(spark, tmp_path):
    path = str(tmp_path / "h")
    tables.write_history(stamped(spark, (f"0@1,{BODY}", 1)), path, 1)
    tables.compact_history(spark, path, 1)
    before = plan(tables.read_history(spark, path))
    for k in range(12):
        tables.write_history(stamped(spark, (f"{k}@1,{BODY}", 1)), path, 1)
    tables.compact_history(spark, path, 1)
    after = plan(tables.read_history(spark, path))
    assert len(after) <= len(before) + 50 and tables.read_history(spark, path).count() == 12
    assert os.listdir(f"{path}/log") and len([f for f in os.listdir(f"{path}/log") if f.startswith("batch")]) == 0


def test_lookup_reads_one_bucket(spark, tmp_path):
    path = str(tmp_path / "h")
    tables.write_history(stamped(spark, *[(f"v{i}@1,{BODY}", 10) for i in range(50)]), path, buckets=8)
    found = hist.track_history(tables.read_history(spark, path), ["v7"], buckets=8)
    assert [r.row_key for r in found.collect()] == ["v7@1"]
    scan = next(x for x in plan(found).split("\n") if "PartitionFilters" in x and "bucket" in x)
    assert "bucket" in scan.split("PartitionFilters")[1].split("]")[0]
    assert "EqualTo(vehicle_id,v7)" in scan


def test_frames_of_ids_open_their_buckets_only(spark, tmp_path, monkeypatch):
    path, lines = str(tmp_path / "h"), stamped(spark, *[(f"v{i}@{t},{BODY}", 10) for i in range(50) for t in range(3)])
    tables.write_history(lines, path, buckets=8)
    tables.compact_history(spark, path, buckets=8)
    tables.write_history(lines.withColumn("arrival_ms", F.lit(20).cast("bigint")), path, buckets=8)
    ids = spark.createDataFrame([(0, "v7"), (1, "v9"), (2, "v7"), (3, "none")], "pos int, vehicle_id string")
    for small in (True, False):
        if not small:
            monkeypatch.setattr(skew, "SMALL_ROWS", 0)
        found = hist.track_history(tables.read_history(spark, path, ids=ids, buckets=8), ids)
        want = hist.track_history(tables.read_history(spark, path), ids)
        assert rows(found, "pos", "row_key", "arrival_ms") == rows(want, "pos", "row_key", "arrival_ms") and found.count() == 9
        assert (plan(found).count("dynamicpruning") >= 2) or not small


def test_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    path, settings = str(tmp_path / "h"), {"advisoryPartitionSizeInBytes": "4k", "coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(f"spark.sql.adaptive.{name}", value)
    try:
        tables.write_history(stamped(spark, *[(f"hot@{i},{BODY}", 10) for i in range(5000)]), path, buckets=8)
    finally:
        for name in settings:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert len(glob.glob(f"{path}/live/*/batch_id=0/bucket=*/*.parquet")) >= 4


def test_empty_table_of_lines(spark, tmp_path):
    tables.write_history(stamped(spark, ("a@1," + BODY, 1)).filter("arrival_ms > 5"), str(tmp_path / "e"))
