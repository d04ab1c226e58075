"""The stored cells against the same changes made to a frame."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from velotrail.operators import mutations as mut
from velotrail.plans import skew
from velotrail.sources import cell_table as ct

CELLS = "row_key string, family string, qualifier string, ts bigint, value string"
CELL = "row_key string, family string, qualifier string"


def some_cell(rng):
    return rng.choice(["r1", "r2", "r3"]), rng.choice(["f", "g"]), rng.choice(["a", "b"])


def random_batch(spark, rng):
    """(change of a frame, change of the table) with the same arguments."""
    kind, now = rng.choice(["puts", "puts", "mutations", "deletes", "increments", "appends"]), rng.randrange(5, 30)
    if kind == "puts":
        df = spark.createDataFrame([(*some_cell(rng), rng.choice([None, rng.randrange(20)]), str(rng.randrange(9))) for _ in range(6)], CELLS)
        return lambda c: mut.put_cells(c, df, now), lambda *a: ct.write_puts(df, a[0], now, *a[1:], buckets=4)
    if kind == "mutations":
        data = []
        for seq in range(8):
            row, family, qualifier = some_cell(rng)
            op = rng.choice(["put", "put", "delete"])
            wide = op == "delete" and rng.random() < 0.3
            data.append((seq, row, family, None if wide else qualifier, op, str(rng.randrange(9)) if op == "put" else None))
        df = spark.createDataFrame(data, f"seq int, {CELL}, op string, value string")
        return lambda c: mut.mutate_rows(c, df, now), lambda *a: ct.write_mutations(df, a[0], now, *a[1:], buckets=4)
    if kind == "deletes":
        df = spark.createDataFrame([(*some_cell(rng), rng.choice([None, rng.randrange(25)]), rng.choice(["row", "family", "columns", "column", "column"])) for _ in range(2)],
                                   f"{CELL}, ts bigint, kind string")
        return lambda c: mut.delete_typed(c, df, now), lambda *a: ct.write_deletes(df, a[0], now, *a[1:], buckets=4)
    if kind == "increments":
        df = spark.createDataFrame([(*some_cell(rng), rng.choice([None, rng.randrange(5)])) for _ in range(4)], f"{CELL}, amount bigint")
        return lambda c: mut.increment_cells(c, df, now)[0], lambda *a: ct.write_increments(df, a[0], now, *a[1:], buckets=4)
    df = spark.createDataFrame([(seq, *some_cell(rng), str(rng.randrange(9))) for seq in range(4)], f"seq int, {CELL}, value string")
    return lambda c: mut.append_cells(c, df, now)[0], lambda *a: ct.write_appends(df, a[0], now, *a[1:], buckets=4)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_equal_changes_of_a_frame(spark, tmp_path, seed):
    """Batches of all kinds, some written twice, copies in between; with a copy the frame keeps its newest versions too."""
    rng, path = random.Random(seed), str(tmp_path / "c")
    frame = spark.createDataFrame([], CELLS)
    for batch_id in range(8):
        of_frame, of_table = random_batch(spark, rng)
        frame = spark.createDataFrame(of_frame(frame).select("row_key", "family", "qualifier", "ts", "value").collect(), CELLS)
        for _ in range(rng.choice([1, 1, 2])):
            assert of_table(path, "r", batch_id)
        if rng.random() < 0.3:
            n = rng.choice([None, 3])
            assert ct.compact_cells(spark, path, n)
            frame = spark.createDataFrame(mut.retain_versions(frame, n or 0).collect(), CELLS)
            assert not of_table(path, "r", batch_id)  # the copy has it
        if batch_id % 2:
            assert rows(ct.read_cells(spark, path)) == rows(frame), batch_id
    assert rows(ct.read_cells(spark, path)) == rows(frame)
    one = spark.createDataFrame([("r2",), ("r9",), ("r2",)], "row_key string")
    assert rows(ct.read_cells(spark, path, keys=one, buckets=4)) == rows(frame.filter("row_key = 'r2'"))


def cell(spark, *data):
    return spark.createDataFrame([("r", "f", q, t, v) for q, t, v in data], CELLS)


def test_marks_and_copies(spark, tmp_path):
    path = str(tmp_path / "c")
    assert ct.read_cells(spark, path).count() == 0 and not ct.compact_cells(spark, path)
    ct.write_puts(cell(spark, ("a", 5, "1"), ("a", 9, "2"), ("b", 5, "3")), path, 0)
    at = ct.Log(spark, path).snapshot()
    ct.write_deletes(spark.createDataFrame([("r", "f", "a", 5, "columns")], f"{CELL}, ts bigint, kind string"), path)
    ct.write_puts(cell(spark, ("a", 4, "late")), path, 0)  # put behind the mark, with a time before it
    assert rows(ct.read_cells(spark, path), "qualifier", "ts", "value") == [("a", 4, "late"), ("a", 9, "2"), ("b", 5, "3")]
    assert rows(ct.read_cells(spark, path, at), "qualifier", "ts") == [("a", 5), ("a", 9), ("b", 5)]
    assert ct.compact_cells(spark, path, ttl_s=1, now_ms=1005)
    assert rows(ct.read_cells(spark, path), "qualifier", "ts") == [("a", 9), ("b", 5)]
    assert ct.Log(spark, path).clean() == 3
    assert rows(ct.read_cells(spark, path), "qualifier", "ts") == [("a", 9), ("b", 5)]
    with pytest.raises(ValueError):
        ct.compact_cells(spark, path, ttl_s=1)
    with pytest.raises(ValueError):
        ct.write_deletes(spark.createDataFrame([("r", "f", "a", 5, "cell")], f"{CELL}, ts bigint, kind string"), path)


def test_a_replayed_count_counts_once(spark, tmp_path):
    """Before a copy the batch replaces itself; behind it, and after cleaning, it is known."""
    path = str(tmp_path / "c")
    one = spark.createDataFrame([("r", "f", "n", 2)] * 3, f"{CELL}, amount bigint")
    for _ in range(3):
        ct.write_increments(one, path, 10, "s", 0)
    ct.write_increments(one, path, 8, "s", 1)
    assert rows(ct.read_cells(spark, path), "ts", "value") == [(10, "12")]
    for _ in range(2):
        ct.compact_cells(spark, path)
        ct.Log(spark, path).clean()
        assert not ct.write_increments(one, path, 20, "s", 1)
        assert rows(ct.read_cells(spark, path), "value") == [("12",)]
        ct.write_puts(cell(spark, ("other", 1, "x")), path, 0)
        ct.write_deletes(spark.createDataFrame([("r", "f", "other", None, "columns")], f"{CELL}, ts bigint, kind string"), path)
    ct.write_puts(cell(spark, ("n", 99, "many")), path, 0)
    ct.write_increments(one, path, 100, "s", 12)
    with pytest.raises(Exception, match="no counter: many"):
        ct.read_cells(spark, path).collect()


def test_the_last_batch_of_a_stream_may_stay_out(spark, tmp_path):
    path = str(tmp_path / "c")
    for k in range(3):
        ct.write_puts(cell(spark, (f"q{k}", 1, "v")), path, 0, "s", k)
    ct.write_puts(cell(spark, ("call", 1, "v")), path, 0)
    assert ct.compact_cells(spark, path, newest=False)
    assert [n for _, n in ct.Log(spark, path).snapshot().batches] == [3, 2]
    assert ct.read_cells(spark, path).count() == 4


def opened(frame):
    return len(frame.inputFiles())


def test_ranges_and_keys_open_few_files(spark, tmp_path):
    """A copy of several files: a range, a prefix and some keys, with a batch behind the copy and without."""
    path, names = str(tmp_path / "c"), [f"{a}{k:03d}" for a in "abé\U0010ffff" for k in range(60)]
    table = spark.createDataFrame([(k, "f", "q", 1, "v") for k in names], CELLS)
    ct.write_puts(table, path, 0, buckets=4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ct.compact_cells(spark, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    every = opened(ct.read_cells(spark, path))
    assert every >= 6
    keys = spark.createDataFrame([("a007",), ("b012",), (None,), ("zz",)], "row_key string")
    for late in (False, True):
        if late:
            ct.write_deletes(spark.createDataFrame([("a005", None, None, 9, "row")], f"{CELL}, ts bigint, kind string"), path, buckets=4)
            names = [n for n in names if n != "a005"]
        found = ct.read_cells(spark, path, start="a003", stop="a010")
        assert sorted(r.row_key for r in found.collect()) == [n for n in names if "a003" <= n < "a010"]
        assert opened(found) <= 2 + late
        for prefix in ("b01", "é", "\U0010ffff", "x"):
            found = ct.read_cells(spark, path, prefix=prefix)
            assert sorted(r.row_key for r in found.collect()) == [n for n in names if n.startswith(prefix)]
            assert opened(found) <= every // 2 + late
        found = ct.read_cells(spark, path, keys=keys, buckets=4)
        assert sorted(r.row_key for r in found.collect()) == ["a007", "b012"]
        assert opened(found) <= 3 + late


def test_requested_rows_open_their_buckets_only(spark, tmp_path):
    path = str(tmp_path / "c")
    ct.write_puts(spark.createDataFrame([(f"k{n}", "f", "q", 1, "v") for n in range(50)], CELLS), path, 0, buckets=8)
    keys = spark.createDataFrame([("k7",)], "row_key string")
    found = ct.read_cells(spark, path, keys=keys, buckets=8)
    assert [r.row_key for r in found.collect()] == ["k7"]
    assert "dynamicpruning" in plan(found)


def test_typed_deletes_are_worked_out_once_and_hot_keys_found_without_resolving(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    path, read = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    kind = F.udf(lambda x: (read.add(1), x)[1], "string").asNondeterministic()
    cells = spark.createDataFrame([("r", "f", "a", 1, "x"), ("r", "f", "a", 2, "y"), ("s", "f", "a", 1, "z"), ("t", "g", "b", 1, "w")], CELLS)
    deletes = spark.createDataFrame([("r", "f", "a", None, "column"), ("s", None, None, 5, "row"), ("t", "g", None, 0, "family")],
                                    "row_key string, family string, qualifier string, ts bigint, kind string")
    ct.write_puts(cells, path, 9, "r", 0, buckets=2)
    ct.write_deletes(deletes.withColumn("kind", kind("kind")), path, None, "r", 1, buckets=2)
    assert read.value == 3
    counted, real = [], skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda df, *args: (counted.append(df), real(df, *args))[1])
    assert rows(ct.read_cells(spark, path), "row_key", "ts") == [("r", 1), ("t", 1)]
    assert counted and not any("Aggregate" in plan(df) for df in counted)
