import pytest
from pyspark.sql import functions as F

from helpers import rows
from velotrail.functions import text
from velotrail.operators import parse

GOOD = "1000001@1700000000001,116.1,40.1,10,20"
EDGE = {
    "short": "1000001@1700000000001,116.1,40.1,10",
    "long": GOOD + ",",
    "no_velocity": "1000001@1700000000001,116.1,40.1,10,",
    "no_time": "1000001,116.1,40.1,10,20",
    "two_times": "1000001@1@2,116.1,40.1,10,20",
    "bad_time": "1000001@x,116.1,40.1,10,20",
    "trailing_at": "1000001@5@,116.1,40.1,10,20",
    "tiny": "1000001@1700000000001,1e-05,-0,10,20",
}


def frame(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


@pytest.mark.parametrize("name,ok", [
    ("short", False), ("long", True), ("no_velocity", False), ("no_time", False), ("two_times", False),
    ("bad_time", False), ("trailing_at", True), ("tiny", True),
])
def test_strict(spark, name, ok):
    parsed = parse.parse_line(frame(spark, EDGE[name]))
    if ok:
        assert parsed.first().vehicle_id == "1000001"
    else:
        with pytest.raises(Exception, match="bad track line"):
            parsed.count()


def test_strict_fails_even_when_no_column_is_used(spark):
    with pytest.raises(Exception, match="bad track line"):
        parse.parse_line(frame(spark, GOOD, EDGE["short"])).count()


def test_strict_null_line_fails(spark):
    with pytest.raises(Exception, match="bad track line"):
        parse.parse_line(frame(spark, None)).count()


@pytest.mark.parametrize("name,reason", [
    ("short", "bad_field_count"), ("long", "bad_field_count"), ("no_velocity", None), ("no_time", "bad_key"),
    ("two_times", "bad_key"), ("bad_time", "bad_time"), ("trailing_at", "bad_key"), ("tiny", None),
])
def test_lenient(spark, name, reason):
    good, rejects = parse.parse_line(frame(spark, GOOD, EDGE[name]), mode="lenient")
    assert rows(rejects) == ([] if reason is None else [(EDGE[name], reason)])
    assert good.count() == (2 if reason is None else 1)


def test_lenient_null_line_is_a_reject(spark):
    good, rejects = parse.parse_line(frame(spark, None, GOOD), mode="lenient")
    assert good.count() == 1 and rows(rejects) == [(None, "bad_field_count")]


def test_lenient_keeps_empty_velocity(spark):
    good, _ = parse.parse_line(frame(spark, EDGE["no_velocity"]), mode="lenient")
    assert good.first().velocity == ""


@pytest.mark.parametrize("name", ["no_time", "two_times", "bad_time"])
def test_key_only_takes_any_key(spark, name):
    parsed = parse.parse_line(frame(spark, EDGE[name]), split_key=False)
    assert parsed.first().row_key == EDGE[name].split(",")[0]


def test_fractional_time_is_read_as_a_number(spark):
    assert parse.parse_line(frame(spark, "7@1.5e3,1,2,3,4")).first().event_ms == 1500


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse.parse_line(frame(spark, GOOD), mode="loose")


def test_hemisphere_by_text_and_by_number(spark):
    df = parse.parse_line(frame(spark, EDGE["tiny"]))
    by_text = text.hemisphere(F.col("longitude"), F.col("latitude"))
    by_number = text.hemisphere(F.col("longitude"), F.col("latitude"), numeric=True)
    assert rows(df.select(*by_text)) == [("W", "S")]
    assert rows(df.select(*by_number)) == [("E", "N")]


def test_units(spark):
    df = spark.createDataFrame([(1700000000123,)], "t bigint")
    got = df.select(text.format_time(F.col("t")), text.format_time(F.floor(F.col("t") / 1000), "s"),
                    text.stamp_text(F.col("t")), text.stamp_text(F.col("t"), "s")).first()
    assert tuple(got) == ("2023-11-14 22:13:20", "2023-11-14 22:13:20", "1700000000123", "1700000000")
    with pytest.raises(ValueError):
        text.format_time(F.col("t"), "us")


def test_report_in_seconds(spark):
    df = frame(spark, "7@1700000000,116.1,-40.1,10,20@1700000001")
    got = parse.track_report(parse.parse_line(df), with_arrival=True, unit="s", now_ms=1700000002500).first().report
    pad = " " * 17
    assert got == (
        "current time is 2023-11-14 22:13:22.500000, trackinfo pushed into redis time is 2023-11-14 22:13:21\n"
        "bicycle 7's track status at time 2023-11-14 22:13:20 is : \n"
        f"{pad}longtitude : 116.1 E\n{pad}latitude   : -40.1 S\n{pad}angle      : 10\n{pad}velocity   : 20\n"
    )


def test_numbers_print_like_c(spark):
    values = [116.0785, 116.0795, 123456.5, 123457.5, 0.0, -0.0, 1e-5, 1.5e-5, -116.0785, 0.0001234565, 1e20,
              1.234565e10, 99999.95, 999999.5, 100.0, 40.0434, 35.0, 21.0, 1234567.0]
    values += [(100000 + 7919 * i % 900000) * 10.0 ** -(i % 9) + 5 * 10.0 ** -(i % 9 + 1) for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    shown = text.general_numbers(df, {"t": "x"}).collect()
    assert [(r.x, r.t) for r in shown if r.t != "%.6g" % r.x] == []


def test_encode_then_parse_gives_the_record_back(spark):
    df = spark.createDataFrame([("1007451", 1700000000123, 116.078, 40.0434, 35.0, 21.0)],
                               "vehicle_id string, event_ms bigint, lon double, lat double, angle_deg double, velocity_kmh double")
    line = parse.encode_track(df)
    assert line.first().line == "1007451@1700000000123,116.078,40.0434,35,21"
    back = parse.with_numbers(parse.parse_line(line.select("line")))
    assert rows(back, *df.columns) == rows(df)


def test_key_hash_wraps_at_32_bits(spark):
    def expected(s):
        h = 5381
        for c in s:
            h = (h * 33 + ord(c)) % 2 ** 32
        return h

    keys = ["", "a", "1000001@1700000000001", "x" * 50]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [tuple(r) for r in df.select("k", text.key_hash(F.col("k"))).collect()] == [(k, expected(k)) for k in keys]


def test_cells_round_trip_and_missing_column(spark):
    lines = frame(spark, GOOD).withColumn("arrival_ms", F.lit(100).cast("bigint"))
    cells = parse.to_cells(parse.parse_line(lines, split_key=False))
    assert ("1000001@1700000000001", "position", "longtitude", 100, "116.1") in rows(cells)
    assert parse.from_cells(cells).first().velocity == "20@100"
    part = cells.filter("qualifier <> 'angle'")
    assert parse.from_cells(part, strict=False).first().angle is None
    with pytest.raises(Exception, match="without all four columns"):
        parse.from_cells(part).collect()
