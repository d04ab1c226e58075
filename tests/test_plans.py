"""Filters and column choices reach the files; nothing meets in one task."""

import pytest
from pyspark.sql import functions as F

import velotrail as vt
from helpers import plan
from velotrail.operators import cells as ops


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "t")
    spark.range(1000).selectExpr(
        "format_string('r%04d', id) AS row_key", "'move' AS family", "'angle' AS qualifier", "id AS ts", "'v' AS value"
    ).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield spark.read.parquet(path)
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def scan_line(df):
    return next(x for x in plan(df).split("\n") if "FileScan" in x)


@pytest.mark.parametrize("make,pushed", [
    (lambda t: ops.scan_range(t, "r0010", "r0020"), ["GreaterThanOrEqual(row_key,r0010)", "LessThan(row_key,r0020)"]),
    (lambda t: ops.scan(t, prefix="r00"), ["StringStartsWith(row_key,r00)"]),
    (lambda t: ops.scan(t, "r0010", columns=["move:angle"]), ["EqualTo(family,move)", "EqualTo(qualifier,angle)"]),
    (lambda t: ops.row_get(t, "r0007"), ["EqualTo(row_key,r0007)"]),
    (lambda t: ops.row_get(t, ts=5), ["EqualTo(ts,5)"]),
    (lambda t: ops.time_range(t, 5, 9), ["GreaterThanOrEqual(ts,5)", "LessThan(ts,9)"]),
    (lambda t: vt.expire_ttl(t, 1, 5000), ["GreaterThanOrEqual(ts,4000)"]),
    (lambda t: vt.page(t, 10, after="r0100"), ["GreaterThan(row_key,r0100)"]),
])
def test_filters_are_pushed(stored, make, pushed):
    line = scan_line(make(stored))
    assert all(p in line for p in pushed), line


def test_only_needed_columns_are_read(stored):
    assert "ReadSchema: struct<row_key:string>" in scan_line(vt.set_size(stored.withColumnRenamed("row_key", "vehicle_id")))
    lines = stored.select(F.col("row_key").alias("vehicle_id"), F.col("ts").alias("event_ms"), "value")
    assert "ReadSchema: struct<ts:bigint>" in scan_line(vt.batch_latency(lines, 10))


def test_a_page_is_a_top_n(stored):
    assert "TakeOrderedAndProject" in plan(vt.page(stored, 10))


def test_keep_last_n_limits_before_the_shuffle(stored):
    members = stored.select(F.col("row_key").alias("vehicle_id"), F.col("ts").cast("double").alias("score"),
                            F.col("value").alias("member"))
    text = plan(vt.keep_last_n(members, 5))
    physical = text[text.index("Physical Plan"):]
    assert physical.index("Final") < physical.index("Exchange hashpartitioning") < physical.index("Partial")


def test_public_names():
    for name in ("parse_line", "track_history", "keep_last_n", "scan", "mutate_rows", "check_and_put", "start_recent", "track_lines"):
        assert callable(getattr(vt, name)) and name in vt.__all__
