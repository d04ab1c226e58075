"""The plans for hot keys give what the ordinary plans give."""

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import plan, rows
from velotrail.plans import ranks, scratch, skew


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    keys = ["hot"] * 400 + ["warm"] * 150 + [f"k{i}" for i in range(40) for _ in range(rng.randrange(1, 9))] + [None] * 120
    rng.shuffle(keys)
    made = [(k, rng.randrange(60), i, float(rng.randrange(100))) for i, k in enumerate(keys)]
    return spark.createDataFrame(made, "k string, t int, id int, x double").repartition(5).cache()


def test_hot_keys(data):
    assert rows(skew.hot_keys(data, ["k"], 100)) == [("", 2), ("hot", 4), ("warm", 2)]
    assert skew.hot_keys(data, ["k"], 1000) is None
    assert skew.hot_keys(data.filter("id < 0"), ["k"], 0) is None
    assert "hot\u000159" in [r[0] for r in rows(skew.hot_keys(data, ["k", "t"], 0))]


def test_hot_keys_among_more_keys_than_the_sketch_tracks(spark):
    df = spark.range(400_000).selectExpr("CASE WHEN id % 10 = 0 THEN 'a' WHEN id % 200 = 1 THEN 'b' ELSE cast(id AS string) END AS k")
    assert [r[0] for r in rows(skew.hot_keys(df.repartition(6), ["k"], 1500))] == ["a", "b"]


def test_keys_with_one_text_are_split_alike(spark):
    df = spark.createDataFrame([("x", None, i) for i in range(20)] + [(None, "x", i) for i in range(20)], "a string, b string, i int")
    order = [F.col("i")]
    want = df.filter("i < 3")
    assert rows(skew.top_n(df, ["a", "b"], order, 3, hot_rows=5)) == rows(want)
    assert rows(ranks.group_rank(df, ["a", "b"], order, "r", hot_rows=5, parts=4).filter("r < 3").drop("r")) == rows(want)


@pytest.mark.parametrize("hot_rows", [0, 100, 200, 10_000])
@pytest.mark.parametrize("n", [1, 3, 50])
def test_top_n(data, hot_rows, n):
    order = [F.col("t").desc(), F.col("id")]
    window = Window.partitionBy("k").orderBy(*order)
    want = data.withColumn("r", F.row_number().over(window)).filter(F.col("r") <= n).drop("r")
    assert rows(skew.top_n(data, ["k"], order, n, hot_rows=hot_rows)) == rows(want)


@pytest.mark.parametrize("hot_rows,parts", [(0, 7), (100, 7), (100, 1), (10_000, None)])
def test_group_rank(data, hot_rows, parts):
    order = [F.col("t"), F.col("id")]
    window = Window.partitionBy("k").orderBy(*order)
    want = (
        data.withColumn("rank", F.row_number().over(window).cast("bigint") - 1)
        .withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("k")))
        .withColumn("before", F.coalesce(F.sum("x").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    )
    got = ranks.group_rank(data, ["k"], order, size="size", sums={"before": F.col("x")}, hot_rows=hot_rows, parts=parts)
    assert rows(got, *want.columns) == rows(want)


def test_group_rank_splits_the_hot_key(spark, data):
    table = ranks._sorted_table(data.filter("k = 'hot'"), [F.col("k"), F.col("t"), F.col("id")], "t", 6)
    sizes = [r["count"] for r in table.groupBy("_part").count().collect()]
    assert len(sizes) > 3 and max(sizes) < 200


def test_copies_of_one_row_spread(spark):
    copies = spark.range(600).select(F.lit("a").alias("k"), F.lit(1).alias("t")).repartition(4)
    table = ranks._sorted_table(copies, [F.col("k"), F.col("t")], "t", 6)
    sizes = [r["count"] for r in table.groupBy("_part").count().collect()]
    assert len(sizes) > 3 and max(sizes) < 300
    got = ranks.group_rank(copies, ["k"], [F.col("t")], "r", hot_rows=10, parts=6)
    assert sorted(r.r for r in got.collect()) == list(range(600))


@pytest.mark.parametrize("parts", [1, 6])
def test_table_rank(data, parts):
    ranked, total = ranks.table_rank(data, [F.col("t"), F.col("id")], "r", parts)
    want = sorted((t, i) for _, t, i, _ in rows(data))
    assert total == len(want)
    assert [(r.t, r.id) for r in sorted(ranked.collect(), key=lambda r: r.r)] == want


def test_table_rank_of_nothing(spark, data):
    ranked, total = ranks.table_rank(data.filter("id < 0"), [F.col("t")], "r")
    assert total == 0 and ranked.count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("small_side,hot_rows", [(True, None), (False, 100), (False, 0), (False, 10_000)])
def test_skew_join(spark, data, how, small_side, hot_rows):
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4)], "k string, y int")
    want = data.join(small, "k", how)
    got = skew.skew_join(data, small, ["k"], how, small_side=small_side, hot_rows=hot_rows)
    assert rows(got, *want.columns) == rows(want)


def test_skew_join_refuses_right_joins(spark, data):
    with pytest.raises(ValueError):
        skew.skew_join(data, data, ["k"], "right")


def test_skew_join_splits_the_hot_key(spark, data):
    small = spark.createDataFrame([("hot", 1)], "k string, y int")
    text = plan(skew.skew_join(data, small, ["k"], small_side=False, hot_rows=100))
    assert "_salt" in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("small_side,hot_rows", [(True, None), (False, 100), (False, 0), (False, 10_000)])
def test_match_with_hot_keys_on_both_sides(spark, data, small_side, hot_rows):
    asked = spark.createDataFrame([("hot", i) for i in range(150)] + [("k1", 1), ("x", 2)], "k string, pos int")
    want = data.join(asked, "k")
    got = skew.match(data, asked, ["k"], hot_rows=hot_rows, small_side=small_side)
    assert rows(got, *want.columns) == rows(want)


def test_small_is_checked_on_the_data(spark, monkeypatch):
    df = spark.range(50)
    assert skew.is_small(df)
    monkeypatch.setattr(skew, "SMALL_ROWS", 49)
    assert not skew.is_small(df)
    monkeypatch.setattr(skew, "SMALL_ROWS", 50)
    monkeypatch.setattr(skew, "SMALL_BYTES", 100)
    assert not skew.is_small(df)


def test_scratch_folder_is_the_one_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert named is None or scratch.scratch_path(spark, "x").startswith(named.rstrip("/"))


def test_scratch_folder_must_be_named_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session())


def test_sizes_are_added_up_where_the_rows_are(spark):
    df = spark.range(1000).repartition(5)
    assert skew.is_small(df) and skew.is_small(df.filter("id < 0"))
    assert not skew.is_small(spark.range(skew.SMALL_ROWS + 1))
    assert not skew.is_small(spark.range(40).withColumn("text", F.expr("repeat('x', 1000000)")))


def test_scratch_is_freed(spark, tmp_path):
    df = spark.range(10)
    with scratch.scratch_scope(spark):
        ranked, total = ranks.table_rank(df, [F.col("id").desc()])
        kept = ranked.inputFiles()
        ranked.write.parquet(str(tmp_path / "out"))
    assert total == 10 and spark.read.parquet(str(tmp_path / "out")).count() == 10
    assert kept and not any(os.path.exists(f.removeprefix("file://").removeprefix("file:")) for f in kept)


def test_hot_keys_with_more_partitions_than_sketches(spark):
    """Tasks of the last step that get no sketch; partitions are not put together."""
    names = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        df = spark.createDataFrame([("a",)] * 30 + [("b",)], "k string").repartition(3)
        assert [r[0] for r in skew.hot_keys(df, ["k"], 10).collect()] == ["a"]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
