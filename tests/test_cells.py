import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from velotrail.operators import cells as ops
from velotrail.operators import mutations as mut
from velotrail.plans import skew

SCHEMA = "row_key string, family string, qualifier string, ts bigint, value string"
CELL = "row_key string, family string, qualifier string"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([
        ("r1", "move", "angle", 10, "a10"), ("r1", "move", "angle", 20, "a20"), ("r1", "move", "angle", 30, "a30"),
        ("r1", "position", "longtitude", 10, "x10"), ("r2", "move", "angle", 15, "b15"),
        ("r2", "move", "velocity", 25, "v25"), ("r10", "move", "angle", 5, "c5"), ("s1", "position", "latitude", 40, "y40"),
    ], SCHEMA)


def test_get_and_versions(spark, table):
    asked = spark.createDataFrame([("r1", "move", "angle"), ("r2", "move", "none")], CELL)
    assert rows(ops.cell_get(table, asked)) == [("r1", "move", "angle", 30, "a30")]
    assert rows(ops.cell_versions(table, asked, 2), "ts") == [(20,), (30,)]
    assert rows(ops.cell_versions(table, asked, 2, ts=20), "ts") == [(10,), (20,)]
    assert rows(ops.cell_versions(table, asked, 2, ts=20, at="exact"), "ts") == [(20,)]
    with pytest.raises(ValueError):
        ops.cell_versions(table, asked, 2, ts=20, at="later")


def test_row_at_a_time(table):
    assert rows(ops.row_get(table, "r1"), "qualifier", "ts") == [("angle", 30), ("longtitude", 10)]
    assert rows(ops.row_get(table, "r1", ts=10), "qualifier", "ts") == [("angle", 10), ("longtitude", 10)]
    assert rows(ops.row_get(table, "r1", ts=25), "ts") == []
    assert rows(ops.row_get(table, "r1", ["move"], ts=25, at="as_of"), "ts") == [(20,)]
    assert rows(ops.row_get(table, ["r2", "s1"], ["move:velocity", "position"]), "value") == [("v25",), ("y40",)]
    assert rows(ops.row_get(table, "nobody")) == []


@pytest.mark.parametrize("small", [True, False])
def test_ordered_rows_and_existence(spark, table, small, monkeypatch):
    if not small:
        monkeypatch.setattr(skew, "SMALL_ROWS", 0)
        monkeypatch.setattr(skew, "HOT_ROWS", 1)
    asked = spark.createDataFrame([(0, "s1"), (1, "zz"), (2, "r2"), (3, "s1"), (4, "s1")], "pos int, row_key string")
    got = [(r.pos, r.qualifier, r.value) for r in ops.rows_get_ordered(table, asked).collect()]
    assert got == [(0, "latitude", "y40"), (1, None, None), (2, "angle", "b15"), (2, "velocity", "v25"),
                   (3, "latitude", "y40"), (4, "latitude", "y40")]
    assert [r.found for r in ops.rows_exist(table, asked).collect()] == [True, False, True, True, True]
    fine = asked.withColumns({"family": F.lit("move"), "qualifier": F.lit("angle")})
    assert [r.found for r in ops.rows_exist(table, fine).collect()] == [False, False, True, False, False]


def test_each_request_at_its_own_time(spark, table):
    asked = spark.createDataFrame([("r1", 20), ("r2", 25), ("r2", 99)], "row_key string, ts bigint")
    assert rows(ops.rows_get(table, asked), "value") == [("a20",), ("v25",)]


def test_time_ranges_are_half_open(spark, table):
    assert rows(ops.time_range(table, 10, 20), "ts") == [(10,), (10,), (15,)]
    ranges = spark.createDataFrame([("move", 10, 20)], "family string, min_ts bigint, max_ts bigint")
    assert rows(ops.family_time_range(table, ranges), "value") == [("a10",), ("b15",), ("x10",), ("y40",)]
    # A timestamp makes the range moot.
    assert rows(ops.scan(table, ts=20, time_limits=(0, 1)), "value") == [("a20",)]


def test_scan(table):
    def keys(df):
        return [(r.row_key, r.qualifier, r.ts) for r in df.collect()]

    assert keys(ops.scan(table, "r1", "r2")) == [("r1", "angle", 30), ("r1", "longtitude", 10), ("r10", "angle", 5)]
    assert keys(ops.scan(table, prefix="s")) == [("s1", "latitude", 40)]
    assert keys(ops.scan(table, prefix="r1", max_versions=2))[:2] == [("r1", "angle", 30), ("r1", "angle", 20)]
    assert len(keys(ops.scan(table, max_versions=None))) == 8
    assert keys(ops.scan(table, reversed=True))[0] == ("s1", "latitude", 40)
    # The predicate comes before versions are counted.
    assert keys(ops.scan(table, where=F.col("value") < "a25", prefix="r1")) == [("r1", "angle", 20)]
    # A pattern has to match the whole qualifier.
    assert keys(ops.scan(table, columns=["position:l.*e", "move:angl"])) == [("r1", "longtitude", 10), ("s1", "latitude", 40)]
    assert keys(ops.scan(table, columns=["position:long"])) == []
    assert keys(ops.scan_limit(ops.scan(table), 2).orderBy("row_key", "qualifier")) == [
        ("r1", "angle", 30), ("r1", "longtitude", 10), ("r10", "angle", 5)]
    assert {k for k, _, _ in keys(ops.scan_limit(ops.scan(table, reversed=True), 2, reversed=True))} == {"s1", "r2"}


def test_row_results_in_parts(table):
    one = ops.newest(table)
    got = {r.row_key: [e["column"] for e in r.columns] for r in ops.as_row_list(one).collect()}
    assert got["r2"] == ["move:angle", "move:velocity"]
    parts = {(r.row_key, r.part): [e["column"] for e in r.columns] for r in ops.as_row_list(one, batch=1).collect()}
    assert parts["r2", 0] == ["move:angle"] and parts["r2", 1] == ["move:velocity"]
    maps = {r.row_key: r.columns for r in ops.as_row_map(one).collect()}
    assert maps["r1"]["move:angle"]["value"] == "a30" and maps["r1"]["move:angle"]["ts"] == 30


def test_retention(table):
    assert rows(mut.retain_versions(table, 2).filter("row_key = 'r1' and qualifier = 'angle'"), "ts") == [(20,), (30,)]
    assert rows(mut.retain_versions(table, 2, hot_rows=1)) == rows(mut.retain_versions(table, 2))
    assert rows(mut.expire_ttl(table.withColumn("ts", F.col("ts") * 1000), 20, 40_000), "ts") == [(20000,), (25000,), (30000,), (40000,)]


def test_a_wide_row_is_one_result_unless_parts_are_asked_for(spark):
    wide = spark.range(10_001).selectExpr("'r' AS row_key", "'f' AS family", "format_string('q%05d', id) AS qualifier", "id AS ts", "'v' AS value")
    assert [r.n for r in ops.as_row_map(wide).select(F.size("columns").alias("n")).collect()] == [10_001]
    assert sorted(r.n for r in ops.as_row_list(wide, batch=10_000).select(F.size("columns").alias("n")).collect()) == [1, 10_000]


def test_reversed_scan_runs_down_from_the_larger_start(table):
    def keys(df):
        return list(dict.fromkeys(r.row_key for r in df.collect()))

    assert keys(ops.scan(table, "r2", "r1", reversed=True)) == ["r2", "r10"]
    assert keys(ops.scan(table, "r1", "r2", reversed=True)) == []
    assert keys(ops.scan(table, reversed=True, limit=1)) == ["s1"]
    assert keys(ops.scan(table, limit=2)) == ["r1", "r10"]
    assert keys(ops.scan(table, prefix="nothing", limit=3)) == []


def test_a_family_range_replaces_the_general_one(spark, table):
    limits = spark.createDataFrame([("move", 150, 250)], "family string, min_ts bigint, max_ts bigint")
    own = spark.createDataFrame([("r", "move", "a", 200, "x"), ("r", "move", "a", 50, "y"), ("r", "position", "b", 50, "z"), ("r", "position", "b", 200, "w")],
                                "row_key string, family string, qualifier string, ts bigint, value string")
    assert rows(ops.scan(own, time_limits=(0, 100), family_limits=limits), "value") == [("x",), ("z",)]


def test_requests_with_limits_of_their_own(spark, table):
    schema = "pos int, row_key string, columns array<string>, ts bigint, min_ts bigint, max_ts bigint, n int"
    asked = spark.createDataFrame([(0, "r1", ["move:angle"], None, None, None, 2), (1, "r1", ["move:angle"], 20, None, None, None),
                                   (2, "r1", None, None, 0, 5, None), (3, "zz", None, None, None, None, None)], schema)
    got = [(r.pos, r.qualifier, r.ts) for r in ops.rows_get_ordered(table, asked).collect()]
    assert got[:3] == [(0, "angle", 30), (0, "angle", 20), (1, "angle", 20)]
    assert got[-1] == (3, None, None)
    assert [r.found for r in ops.rows_exist(table, asked).collect()] == [True, True, got[3][1] is not None, False]


def test_limits_of_requests_reach_the_scan(spark, tmp_path):
    table = spark.createDataFrame([(f"r{k % 5}", "f", "q", k, str(k)) for k in range(100)], "row_key string, family string, qualifier string, ts bigint, value string")
    table.write.parquet(str(tmp_path / "c"))
    table = spark.read.parquet(str(tmp_path / "c"))
    asked = spark.createDataFrame([(0, "r1", 10, 50, 2), (1, "r2", 20, 60, 1)], "pos int, row_key string, min_ts bigint, max_ts bigint, n int")
    got = [(r.pos, r.ts) for r in ops.rows_get_ordered(table, asked).collect()]
    assert got == [(0, 46), (0, 41), (1, 57)]
    met = ops._limited(table, asked, ["row_key"], "exact")
    assert "GreaterThanOrEqual(ts,10)" in plan(met) and "LessThan(ts,60)" in plan(met)
    open_ = asked.unionByName(spark.createDataFrame([(2, "r1", None, 50, 1)], asked.schema))
    assert "GreaterThanOrEqual(ts" not in plan(ops._limited(table, open_, ["row_key"], "exact"))
