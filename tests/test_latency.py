import math

import pytest
from pyspark.sql import functions as F

from helpers import rows
from velotrail.operators import distribute, latency, motion, parse


def track(spark, *triples):
    return spark.createDataFrame(list(triples), "vehicle_id string, event_ms bigint, arrival_ms bigint, line string")


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_groups_of_100_of_250(spark, hot_rows):
    df = track(spark, *[("a", i, i + 10, f"l{i:03d}") for i in range(250)])
    got = latency.delay_report(df, now_ms=1000, hot_rows=hot_rows).orderBy("group_no").collect()
    assert [(r.group_no, r.n, r.avg_send_to_write) for r in got] == [(0, 100, 10), (1, 100, 10)]
    assert got[0].avg_send_to_read == math.floor(sum(1000 - i for i in range(100)) / 100)
    assert got[0].mean_send_to_read == sum(1000 - i for i in range(100)) / 100


def test_negative_average_is_rounded_down(spark):
    df = track(spark, *[("a", 1 if i == 0 else 0, 0, f"l{i:03d}") for i in range(100)])
    assert latency.delay_report(df, now_ms=5).first().avg_send_to_write == -1


def test_batch_latency(spark):
    df = track(spark, ("a", 10, 0, "x"), ("b", 20, 0, "y"))
    assert rows(latency.batch_latency(df, 100)) == [(2, 170.0, 85.0)]
    assert rows(latency.batch_latency(df.filter("event_ms > 99"), 100)) == []


@pytest.mark.parametrize("by,hot_rows", [(None, None), ("vehicle_id", None), ("vehicle_id", 2)])
def test_progress_marks(spark, by, hot_rows):
    df = track(spark, *[("a", 0, i, f"l{i}") for i in range(10)])
    got = latency.progress_marks(df, every=4, by=by, hot_rows=hot_rows)
    assert rows(got, "running_count", "arrival_ms") == [(4, 3), (8, 7)]


def test_throughput(spark):
    df = track(spark, *[("a", 0, 1000 + 500 * i, "x") for i in range(5)])
    assert rows(latency.throughput(df)) == [(5, 1000, 3000, 2.5)]
    assert rows(latency.throughput(df.filter("arrival_ms < 0"))) == [(0, None, None, None)]


def test_parallelism_takes_effect(spark):
    assert distribute.with_parallelism(spark.range(100), 7).rdd.getNumPartitions() == 7
    assert distribute.deal(spark.range(100), 5).rdd.getNumPartitions() == 5


def test_deal_in_order(spark):
    got = distribute.deal_in_order(spark.range(10).toDF("i"), 3, [F.col("i")])
    assert rows(got, "i", "queue") == [(i, i % 3) for i in range(10)]


def test_rows_are_where_their_hash_says(spark):
    df = spark.range(200).selectExpr("cast(id as string) as vehicle_id")
    placed = distribute.partition_by_hash(df, 6).withColumn("p", F.spark_partition_id())
    assert placed.filter("p <> partition_no").count() == 0 and placed.select("p").distinct().count() == 6


def test_union_keeps_copies(spark):
    assert distribute.union_sources(spark.range(3), spark.range(3), spark.range(2)).count() == 8


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_path_moves_with_the_earlier_heading(spark, hot_rows):
    made = [("a", i, f"a@{i},0,0,{angle},{speed}") for i, (angle, speed) in enumerate([(0, 36), (90, 72), (45, 18), (180, 36), (10, 20)])]
    lines = spark.createDataFrame(made, "v string, e bigint, line string").select("line")
    df = parse.with_numbers(parse.parse_line(lines))
    got = motion.integrate_track(df, 116.0, 40.0, 10, hot_rows=hot_rows).orderBy("event_ms").collect()
    lon, lat = 116.0, 40.0
    for r in got:
        assert r.path_lon == pytest.approx(lon, abs=1e-12) and r.path_lat == pytest.approx(lat, abs=1e-12)
        heading = r.angle_deg * 3.1415926 / 180
        lon += 8.9832e-6 * r.velocity_kmh / 3.6 * 10 * math.cos(heading)
        lat += 8.9832e-6 * r.velocity_kmh / 3.6 * 10 * math.sin(heading)
