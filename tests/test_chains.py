"""Long chains of conditional changes in segments, against checks one after the other."""

import random

import pytest

from helpers import rows
from velotrail.operators import chains
from velotrail.operators import checks as chk

PASSES = chk._fold_functions()[0]
OPS = ("<", "<=", "=", "<>", ">=", ">", "exists")
CELLS = "row_key string, family string, qualifier string, ts bigint, value string"


def random_check(rng, values):
    op = rng.choice(OPS)
    expected = None if rng.random() < 0.15 else rng.choice(values)
    kind = rng.random()
    steps = [] if kind < 0.2 else [{"op": "delete", "value": None}] if kind < 0.35 else [{"op": "put", "value": rng.choice(values)}]
    return op, expected, rng.choice([None] * 9 + [True]) if steps else None, steps


def run(value, checks):
    for op, expected, passed, steps in checks:
        if (PASSES(value, op, expected) if passed is None else passed) and steps:
            value = steps[-1]["value"]
    return value


@pytest.mark.parametrize("seed", range(6))
def test_a_segment_does_what_its_checks_do(seed):
    """For every value that its checks name, for values between them, and for none."""
    rng = random.Random(seed)
    for _ in range(150):
        values = [rng.choice("abcdefé") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 7))]
        checks = [random_check(rng, values) for _ in range(rng.randrange(1, 30))]
        table = chains.results_of(checks)
        for value in [None, "", "0", "zz", *values, *[v + "0" for v in values]]:
            assert chains.result_for(value, *table) == run(value, checks), (value, checks)


@pytest.mark.parametrize("start", [None, "b"])
def test_segments_equal_one_stream(spark, monkeypatch, start):
    """One cell with hundreds of checks, beside short chains and one on several cells."""
    rng, values = random.Random(5), ["a", "b", "c", "dd", "é"]
    cells = spark.createDataFrame(([("hot", "f", "q", 1, start)] if start else []) + [("other", "f", "q", 1, "a"), ("two", "f", "q", 1, "b")], CELLS)
    checks, steps = [], []
    for seq in range(400):
        row = "hot" if seq % 20 < 17 else "other" if seq % 20 < 19 else "two"
        op, expected, _, own = random_check(rng, values)
        checks.append((seq, row, "f", "q", op, expected))
        for step, s in enumerate(own):
            steps.append((seq, step, "f", "r" if row == "two" and seq % 40 == 19 else "q", s["op"], s["value"]))
    checks = spark.createDataFrame(checks, "seq bigint, row_key string, family string, qualifier string, op string, expected string")
    steps = spark.createDataFrame(steps, "seq bigint, step bigint, family string, qualifier string, op string, value string")
    plain = [rows(x) for x in chk.check_and_mutate(cells, checks, steps, 100)]
    assert len({r[2] for r in plain[1]}) == 2
    cut, made = chains.cut, []
    monkeypatch.setattr(chains, "cut", lambda *a: made.append(1) or cut(*a))
    monkeypatch.setattr(chains, "SEGMENT", 23)
    assert [rows(x) for x in chk.check_and_mutate(cells, checks, steps, 100)] == plain
    assert made


def test_a_million_checks_of_one_cell_are_many_tables():
    """A segment of compare-and-set checks, as large as they get."""
    n = chains.SEGMENT
    checks = [("=", f"v{k % 5000}", None, [{"op": "put", "value": f"v{(k + 1) % 5000}"}]) for k in range(n)]
    points, same, results = chains.results_of(checks)
    assert len(points) == 5000 and chains.result_for("w", points, same, results) == "w"
    assert chains.result_for("v0", points, same, results) == run("v0", checks)
    assert chains.result_for("v4321", points, same, results) == run("v4321", checks)
