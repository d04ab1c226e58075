"""Changes against a plain Python table."""

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from velotrail.operators import cells as ops
from velotrail.operators import checks as chk
from velotrail.operators import mutations as mut
from velotrail.plans import skew
from velotrail.plans.scratch import write_out

SCHEMA = "row_key string, family string, qualifier string, ts bigint, value string"
CELL = "row_key string, family string, qualifier string"
NOW = 100


passes_in_python, _ = chk._fold_functions()


@pytest.fixture(params=["small", "large"])
def size(request, monkeypatch):
    """Run with a broadcast batch, and with a batch and keys that count as huge."""
    if request.param == "large":
        monkeypatch.setattr(skew, "SMALL_ROWS", 0)
        monkeypatch.setattr(skew, "HOT_ROWS", 3)
    return request.param


def random_table(rng, n=80):
    made = {}
    for _ in range(n):
        made[rng.choice(["r1", "r1", "r2", "r3"]), rng.choice(["f", "g"]), rng.choice("abc"), rng.randrange(0, 99)] = str(rng.randrange(5))
    return made


def frame(spark, table):
    return spark.createDataFrame([(*k, v) for k, v in table.items()], SCHEMA)


def as_rows(table):
    return sorted(((*k, v) for k, v in table.items()), key=repr)


def newest(table, cell):
    found = {k[3]: v for k, v in table.items() if k[:3] == cell}
    return found[max(found)] if found else None


def erase(table, match):
    for k in [k for k in table if match(k)]:
        del table[k]


def test_put(spark, size):
    table = frame(spark, {("r", "f", "a", 10): "old", ("r", "f", "b", 10): "kept"})
    puts = spark.createDataFrame([
        ("r", "f", "a", 10, 50, "cell time"), ("r", "f", "c", None, 50, "put time"), ("r", "f", "d", None, None, "now"),
        ("r", "f", "d", None, None, "later"),
    ], CELL + ", ts bigint, put_ts bigint, value string")
    assert rows(mut.put_cells(table, puts, NOW)) == [
        ("r", "f", "a", 10, "cell time"), ("r", "f", "b", 10, "kept"), ("r", "f", "c", 50, "put time"), ("r", "f", "d", 100, "now")]


@pytest.mark.parametrize("seed", [1, 2])
def test_mutations_equal_one_by_one(spark, size, seed):
    rng = random.Random(seed)
    table = random_table(rng)
    batch = []
    for seq in range(60):
        row, family, qualifier = rng.choice(["r1", "r1", "r2", "r4"]), rng.choice("fg"), rng.choice("abcd")
        kind = rng.choice(["put", "put", "delete", "family"])
        batch.append((seq, row, family, None if kind == "family" else qualifier, "put" if kind == "put" else "delete", f"v{seq}"))
    start = frame(spark, table)
    for seq, row, family, qualifier, op, value in batch:
        if op == "put":
            table[row, family, qualifier, 50] = value
        else:
            erase(table, lambda k: k[0] == row and k[1] == family and (qualifier is None or k[2] == qualifier) and k[3] <= 50)
    changes = spark.createDataFrame(batch, "seq bigint, " + CELL + ", op string, value string")
    assert rows(mut.mutate_rows(start, changes, 50)) == as_rows(table)


def test_increment(spark, size):
    table = frame(spark, {("r", "f", "a", 10): "1", ("r", "f", "a", 20): "5", ("r", "f", "t", 1): "text"})
    steps = spark.createDataFrame([("r", "f", "a", 2), ("r", "f", "a", None), ("r", "f", "n", -4)], CELL + ", amount bigint")
    after, values = mut.increment_cells(table, steps, NOW)
    assert rows(values) == [("r", "f", "a", 8), ("r", "f", "n", -4)]
    assert rows(ops.newest(after), "qualifier", "value") == [("a", "8"), ("n", "-4"), ("t", "text")]
    one_by_one = table
    for i, amount in enumerate((2, 1)):
        one_by_one, _ = mut.increment_cells(
            one_by_one, spark.createDataFrame([("r", "f", "a", amount)], CELL + ", amount bigint"), NOW + i)
    assert ("r", "f", "a", NOW + 1, "8") in rows(one_by_one)
    no_amount, counted = mut.increment_cells(table, steps.drop("amount"), NOW)
    assert rows(counted) == [("r", "f", "a", 7), ("r", "f", "n", 1)]
    with pytest.raises(Exception, match="no counter"):
        mut.increment_cells(table, spark.createDataFrame([("r", "f", "t", 1)], CELL + ", amount bigint"), NOW)[1].collect()


@pytest.mark.parametrize("chunk", [3, 1000])
def test_append(spark, size, chunk):
    table = frame(spark, {("r", "f", "a", 10): "x", ("r", "f", "b", 10): "y"})
    parts = spark.createDataFrame([("r", "f", q, i, f"-{i}") for i in range(25) for q in "an"], CELL + ", seq bigint, value string")
    after, values = mut.append_cells(table, parts.orderBy(F.rand(3)), NOW, chunk)
    joined = "".join(f"-{i}" for i in range(25))
    assert rows(values, "qualifier", "value") == [("a", "x" + joined), ("n", joined)]
    assert after.count() == 4


@pytest.mark.parametrize("ts", [None, 40])
def test_deletes(spark, size, ts):
    table = random_table(random.Random(3))
    asked = [("r1", "f", "a"), ("r1", "f", "a"), ("r3", "g", "b"), ("nobody", "f", "a")]
    start = frame(spark, table)
    want = dict(table)
    erase(want, lambda k: k[:3] in asked and (ts is None or k[3] <= ts))
    requests = spark.createDataFrame(asked, CELL)
    left = mut.delete_column(start, requests, ts)
    assert rows(left) == as_rows(want)
    if ts is None:
        assert ops.cell_get(left, requests).count() == 0
    want = dict(table)
    erase(want, lambda k: k[0] in ("r1", "zz") and (ts is None or k[3] <= ts))
    assert rows(mut.delete_row(start, spark.createDataFrame([("r1",), ("zz",)], "row_key string"), ts)) == as_rows(want)


def test_typed_deletes(spark, size):
    table = random_table(random.Random(4), 150)
    exact = next(k for k in table if k[:3] == ("r2", "f", "b"))
    deletes = [
        ("r1", "f", None, "family", 40), ("r1", "g", "a", "columns", 60), ("r1", "g", "b", "column", None),
        ("r2", "f", "a", "columns", None), (*exact[:3], "column", exact[3]), ("r2", "g", "c", "column", 1000),
        ("r3", None, None, "row", 30), ("r3", "g", None, "family", None),
    ]
    want = dict(table)
    last = max(k[3] for k in table if k[:3] == ("r1", "g", "b"))
    erase(want, lambda k: k[:2] == ("r1", "f") and k[3] <= 40 or k[:3] == ("r1", "g", "a") and k[3] <= 60
          or k == ("r1", "g", "b", last) or k[:3] == ("r2", "f", "a") or k == exact
          or k[0] == "r3" and k[3] <= 30 or k[:2] == ("r3", "g") and k[3] <= 90)
    batch = spark.createDataFrame(deletes, CELL + ", kind string, ts bigint")
    want.update({k: v for k, v in table.items() if k[:3] == ("r2", "f", "a") and k[3] > 90})
    assert rows(mut.delete_typed(frame(spark, table), batch, now_ms=90)) == as_rows(want)
    with pytest.raises(Exception, match="unknown kind"):
        mut.delete_typed(frame(spark, table), batch.withColumn("kind", F.lit("some"))).collect()


# (stored, op, expected) -> passes
@pytest.mark.parametrize("stored,op,expected,passes", [
    ("5", "=", "5", True), ("5", "=", "6", False), ("5", "<>", "6", True), ("5", "<", "6", True), ("5", "<=", "5", True),
    ("5", ">", "10", True), ("5", ">=", "6", False), ("5", "exists", None, True), ("5", "=", None, False), ("5", "<>", None, True),
    ("5", "<", None, False), (None, "=", None, True), (None, "=", "5", False), (None, "<>", "5", False), (None, "exists", None, False),
    (None, "<>", None, False),
])
def test_comparisons(spark, stored, op, expected, passes):
    df = spark.createDataFrame([(stored, op, expected)], "s string, o string, e string")
    assert df.select(chk.holds(F.col("s"), F.col("o"), F.col("e"))).first()[0] is passes
    assert passes_in_python(stored, op, expected) is passes


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_checks_equal_one_by_one(spark, size, seed):
    """Chains of a row, chains of a cell, single checks, deletes, families and several steps."""
    rng = random.Random(seed)
    table = random_table(rng, 40)
    start = frame(spark, table)
    checks, steps, want = [], [], []
    for seq in range(80):
        row = rng.choice(["r1", "r2", "own", "own", f"single{seq}"])
        family, qualifier = rng.choice("fg"), rng.choice("abc")
        op, expected = rng.choice(chk.OPS), rng.choice([None, "0", "1", "2", "3"])
        checks.append((seq, row, family, qualifier, op, expected))
        own = row == "own"
        todo = []
        for step in range(1 if own else rng.randrange(0, 3)):
            kind = rng.choice(["put", "put", "delete"] if own else ["put", "put", "delete", "family"])
            target = (family, qualifier) if own else (rng.choice("fg"), rng.choice("abc"))
            todo.append((seq, step, target[0], None if kind == "family" else target[1],
                         "put" if kind == "put" else "delete", str(rng.randrange(4)) if kind == "put" else None))
        steps += todo
        passed = passes_in_python(newest(table, (row, family, qualifier)), op, expected)
        want.append((seq, row, passed))
        for _, _, f, q, action, value in todo if passed else ():
            if action == "put":
                table[row, f, q, NOW] = value
            else:
                erase(table, lambda k: k[0] == row and k[1] == f and (q is None or k[2] == q) and k[3] <= NOW)
    after, outcome = chk.check_and_mutate(
        start, spark.createDataFrame(checks, "seq bigint, " + CELL + ", op string, expected string"),
        spark.createDataFrame(steps, "seq bigint, step bigint, family string, qualifier string, op string, value string"), NOW,
    )
    assert rows(outcome) == sorted(want, key=repr)
    assert rows(after) == as_rows(table)


def test_unknown_comparison_fails(spark):
    checks = spark.createDataFrame([(1, "r", "f", "a", "~", "1")], "seq bigint, " + CELL + ", op string, expected string")
    steps = spark.createDataFrame([(1, 0, "f", "a", "put", "1")], "seq bigint, step bigint, family string, qualifier string, op string, value string")
    with pytest.raises(Exception, match="unknown comparison"):
        chk.check_and_mutate(frame(spark, {("r", "f", "a", 1): "1"}), checks, steps, NOW)


def test_check_and_put_and_delete(spark, size):
    table = frame(spark, {("r", "f", "a", 10): "1", ("r", "g", "x", 10): "x", ("q", "f", "a", 10): "2"})
    puts = spark.createDataFrame([(1, "r", "f", "a", "1", "f", "b", "new"), (2, "q", "f", "a", "1", "f", "b", "no"),
                                  (3, "z", "f", "a", None, "f", "a", "first")],
                                 "seq bigint, " + CELL + ", expected string, put_family string, put_qualifier string, put_value string")
    after, outcome = chk.check_and_put(table, puts, NOW)
    assert rows(outcome, "seq", "passed") == [(1, True), (2, False), (3, True)]
    assert after.count() == 5
    drops = spark.createDataFrame([(1, "r", "f", "a", "1", "g", None), (2, "q", "f", "a", "9", "f", "a")],
                                  "seq bigint, " + CELL + ", expected string, delete_family string, delete_qualifier string")
    after, outcome = chk.check_and_delete(table, drops, NOW)
    assert rows(outcome, "seq", "passed") == [(1, True), (2, False)]
    assert rows(after, "row_key", "family") == [("q", "f"), ("r", "f")]


@pytest.mark.parametrize("result", ["cells", "outcome"])
def test_many_checks_are_not_broadcast(spark, monkeypatch, tmp_path, result):
    """With more rows than is_small allows, no step leaves it to Spark's guess of a table's size."""
    monkeypatch.setattr(skew, "SMALL_ROWS", 2)
    written = []
    monkeypatch.setattr(chk, "write_out", lambda df, label: (written.append(df), write_out(df, label))[1])
    table = frame(spark, {(k, "f", "a", 10): k for k in "pqrs"})
    puts = spark.createDataFrame([(i, "pqrs"[i % 4], "f", "a", "pqrs"[i % 4] if i < 4 else "new", "f", "a", "new") for i in range(8)],
                                 "seq bigint, " + CELL + ", expected string, put_family string, put_qualifier string, put_value string")
    puts.write.parquet(str(tmp_path / "puts"))
    both = chk.check_and_put(table, spark.read.parquet(str(tmp_path / "puts")), NOW)
    assert rows(both[1], "seq", "passed") == [(i, True) for i in range(8)]
    assert rows(both[0].filter(f"ts = {NOW}"), "row_key", "value") == [(k, "new") for k in "pqrs"]
    for df in [both[0]] if result == "cells" else written:
        assert "BroadcastExchange" not in plan(df)


def test_workers_need_no_copy_of_the_package(tmp_path):
    from pyspark import cloudpickle

    sent = cloudpickle.dumps(chk._fold_functions()[1])
    load = "import sys; from pyspark import cloudpickle; cloudpickle.loads(sys.stdin.buffer.read()); assert 'velotrail' not in sys.modules"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", load], input=sent, cwd=tmp_path, env=environment, capture_output=True)
    assert done.returncode == 0, done.stderr


def test_counters_and_appends_under_a_clock_behind_the_stored_time(spark):
    table = spark.createDataFrame([("r", "f", "n", 100, "5"), ("r", "f", "t", 100, "a")], CELL + ", ts bigint, value string")
    one = spark.createDataFrame([("r", "f", "n", 1)], CELL + ", amount bigint")
    after, values = mut.increment_cells(table, one, 50)
    assert rows(values) == [("r", "f", "n", 6)]
    assert ("r", "f", "n", 100, "6") in rows(after) and after.filter("qualifier = 'n'").count() == 1
    more = spark.createDataFrame([("r", "f", "t", 1, "b")], CELL + ", seq bigint, value string")
    after, _ = mut.append_cells(table, more, 50)
    assert rows(after.filter("qualifier = 't'"), "ts", "value") == [(100, "ab")]
