import math
import os
from collections import Counter

import numpy as np
import pytest

from velotrail.llm import whitening
from velotrail.llm.queries import QUERIES
from velotrail.llm.whitening import whiten

SF = "/root/testdata/sf0.001"


def frame(spark, data):
    return spark.createDataFrame([(*r, 7, 7.0, "7") for r in data], "vec_id long, embedding array<float>, component int, whitened double, x string")


def plain(data, most=16):
    """n, and for each usable row its id, deviation, x - mean; and the eigenpairs of the covariance."""
    usable = [(i, v) for i, v in data if v and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(Counter(len(v) for _, v in usable).items(), key=lambda x: x[::-1])[0]
    ints = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v)) for i, v in usable if len(v) == dims]
    fit = sorted({x for _, x in ints})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:most], vector[:, ::-1][:, :most]
    real = value > 1e-10 * value[0]
    rows = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.array([(n * c - s) / n for c, s in zip(x, sums)])) for i, x in ints]
    return n, rows, value[real], vector[:, real], np.square(centred).sum() / n


def compare(got, data, precise=1e-8):
    n, rows, value, vector, trace = plain(data)
    assert len(got) == len(rows) * len(value)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation, r.component), []).append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(value[r.component - 1] / trace, rel=1e-10)
    for k in range(len(value)):
        ours = np.array([by[(i, d, k + 1)][0].whitened for i, d, _ in rows])
        want = np.array([c @ vector[:, k] / np.sqrt(value[k]) for _, _, c in rows])
        assert min(np.abs(ours - want).max(), np.abs(ours + want).max()) < precise
    assert Counter((r.vec_id, r.deviation) for r in got) == Counter({k: v * len(value) for k, v in Counter((i, d) for i, d, _ in rows).items()})


def random_vectors(rng, n, dims, scales=None):
    scales = np.ones(dims) if scales is None else scales
    return [(k, [float(c) for c in rng.standard_normal(dims) * scales]) for k in range(n)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_equals_a_dense_solver(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    compare(QUERIES["op11_whitening"](spark, SF).collect(), [tuple(r) for r in table.select("vec_id", "embedding").collect()])


@pytest.mark.parametrize("direct", [512, 0])
def test_one_component_far_above_the_rest(spark, monkeypatch, direct):
    """Values over many orders of size, close ones below; partial sums with and without a second step."""
    monkeypatch.setattr(whitening, "DIRECT", direct)
    rng = np.random.default_rng(4)
    data = random_vectors(rng, 400, 50, np.concatenate([[4000, 300, 40], np.linspace(3, 2, 47)]))
    compare(whiten(frame(spark, data).repartition(3)).collect(), data, 1e-6)


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = random_vectors(rng, 60, 5)
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 1.0, 2.0]), (103, [float("nan")] * 5), (104, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1.0] * 6), (None, good[3][1]), (7, good[3][1]), good[8], good[8], (107, [3e38] + [0.0] * 4)]
    got = whiten(frame(spark, good + odd).repartition(4)).collect()
    usable = [r for r in good + odd if r[1] and len(r[1]) == 5 and r[0] != 107]
    compare(got, usable)
    assert {r.component for r in got} == set(range(1, 6))


def test_fewer_vectors_than_dimensions(spark):
    rng = np.random.default_rng(6)
    data = random_vectors(rng, 8, 40)
    got = whiten(frame(spark, data)).collect()
    assert {r.component for r in got} == set(range(1, 8))
    compare(got, data)


def test_nothing_to_whiten(spark):
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [None])])).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_long_deviations_are_exact():
    x = np.array([[1 << 40, 5], [3, -(1 << 41)]], np.int64)
    n, sums = 3, [7, 11]
    want = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening._deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]
    assert whitening._deviations(x >> 30, n, sums) == [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x >> 30]
