"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers, so that counts, sums and deviations are exact.  Eigenvectors of the covariance V of the distinct
vectors X are never taken from V itself: V times a narrow block Q is the sum of Xc^T (Xc Q) over all tasks, Xc being centred
before multiplying, and only blocks of that size reach the driver.  A filter applies the Chebyshev polynomial of V to
the block, by its recurrence one such pass a degree: it stays small on the unwanted part of the spectrum, between a lower
bound from a few Lanczos steps and the block's own last value, and grows fast above it.  QR and Rayleigh-Ritz turn the block
into approximate eigenpairs.  This goes on until all wanted residuals are certified as small and get no smaller.

The degree is held so low that wanted components stay within FILTER_RANGE of each other, else the largest would drown the rest.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.llm.tables import map_batches
from velotrail.plans.scratch import write_out

#: How entries become integers: floor(SCALE * c) + SHIFT.  A scaled entry of MOST or more counts as non-finite.
SCALE, SHIFT, MOST = 64, 1_000_000, 2.0**62
COMPONENTS = 16
#: Columns of the block for each wanted component.
GUARD = 2
#: Largest degree, and how far the filter may pull wanted components apart.
DEGREE, FILTER_RANGE = 16, 1e8
LANCZOS = 10
#: A pair is certified when |V q - e q| is at most CERTIFIED * e; iteration goes on while residuals shrink by SHRINK.
CERTIFIED, SHRINK, ROUNDS = 1e-11, 0.25, 200
#: Eigenvalues up to this share of the largest count as 0: their components do not exist.
RANK = 1e-10
#: Partial sums that the driver adds itself; more are first added by tasks.
DIRECT = 512
WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _usable(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have ``dims`` finite entries, and their integers."""
    fits = pc.equal(pc.fill_null(pc.list_value_length(column), -1), dims)
    ok = fits.to_numpy(zero_copy_only=False)
    value = column.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(value * SCALE)
        fine = (np.abs(scaled) < MOST).all(axis=1)  # not so for what is absent, since it is read as NaN
    ok[ok] = fine
    return ok, scaled[fine].astype(np.int64) + SHIFT


def _integers(dims: int):
    def run(batches):
        for batch in batches:
            _, x = _usable(batch.column(0), dims)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary())], ["x"])

    return run


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


def _reduced(vectors: DataFrame, part: Callable[[np.ndarray], list[np.ndarray]], dims: int, direct: bool) -> list[np.ndarray]:
    """Sums over all vectors of what ``part`` makes of some of them (a list of arrays, always of the same shapes)."""

    def add(total, own):
        return own if total is None else [a + b for a, b in zip(total, own, strict=True)]

    def out(total):
        values = [pa.array([a.astype(a.dtype.newbyteorder("<")).tobytes()], pa.binary()) for a in total]
        return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), *values], names)

    def each(batches):
        total = None
        for batch in batches:
            x = _vectors(batch.column(0), dims)
            total = add(total, part(x)) if len(x) else total
        if total is not None:
            yield out(total)

    def merge(batches):
        total = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                total = add(total, [np.frombuffer(v, a.dtype) for v, a in zip(row, shapes, strict=True)])
        if total is not None:
            yield out(total)

    shapes = part(np.zeros((0, dims), np.int64))
    names = ["task", *[f"v{k}" for k in range(len(shapes))]]
    schema = "task int, " + ", ".join(f"{name} binary" for name in names[1:])
    sums = map_batches(vectors, each, schema)
    if not direct:
        sums = map_batches(sums.repartitionById(64, F.col("task") % 64), merge, schema)
    total = [a.copy() for a in shapes]
    for row in sorted(sums.collect(), key=lambda r: r.task):
        total = [a + np.frombuffer(v, a.dtype).reshape(a.shape) for a, v in zip(total, row[1:], strict=True)]
    return total


@dataclass
class _Fit:
    """The distinct vectors, their number and sums, and what belongs to their covariance."""

    vectors: DataFrame
    dims: int
    n: int
    sums: list[int]
    direct: bool

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """Rounded once: an integer is taken off first, then the rest of the mean."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s - int(w) * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])
        return lambda x: (x - whole).astype(np.float64) - rest

    def times(self, block: np.ndarray) -> np.ndarray:
        """V times a block: one pass over all vectors."""
        centre = self.centre()
        none = np.zeros(block.shape)

        def part(x):
            if not len(x):
                return [none.copy()]
            c = centre(x)
            return [c.T @ (c @ block)]

        return _reduced(self.vectors, part, self.dims, self.direct)[0].reshape(block.shape) / self.n

    def trace(self) -> float:
        centre = self.centre()
        return float(_reduced(self.vectors, lambda x: [np.square(centre(x)).sum(keepdims=True).reshape(1)], self.dims, self.direct)[0][0]) / self.n


def _fit(vectors: DataFrame, dims: int) -> _Fit:
    def part(x):
        low = x & 0xFFFFFFFF  # two halves, whose sums cannot overflow below 2**31 rows of a task
        return [np.array([len(x)], np.int64), (x >> 32).sum(axis=0, dtype=np.int64), low.sum(axis=0, dtype=np.int64), np.array([1 if len(x) else 0], np.int64)]

    n, high, low, batches = _reduced(vectors, part, dims, False)
    return _Fit(vectors, dims, int(n[0]), [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)], int(batches[0]) <= DIRECT)


def _least(fit: _Fit, rng: np.random.Generator) -> float:
    """A lower bound of the spectrum: the least Ritz value of some Lanczos steps, less its residual."""
    q = rng.standard_normal((fit.dims, 1))
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS, fit.dims)):
        w = fit.times(basis[-1])
        alpha.append((basis[-1].T @ w).item())
        for _ in range(2):
            w = w - np.hstack(basis) @ (np.hstack(basis).T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha):
            break
        basis.append(w / beta[-1])
    values, parts = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1))
    return max(0.0, float(values[0] - beta[-1] * abs(parts[-1, 0])))


def _degree(high: float, wanted: float, centre: float, half: float) -> int:
    apart = math.acosh(max(1.0, (high - centre) / half)) - math.acosh(max(1.0, (wanted - centre) / half))
    return DEGREE if apart <= 0 else max(2, min(DEGREE, int(math.log(FILTER_RANGE) / apart)))


def _filtered(fit: _Fit, q: np.ndarray, vq: np.ndarray, low: float, cut: float, high: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on [low, cut], scaled to 1 at ``high``, times the block; ``vq`` is V q."""
    centre, half = (low + cut) / 2, (cut - low) / 2
    first = sigma = half / (high - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (2 * after / half) * (fit.times(now) - centre * now) - sigma * after * before
        sigma = after
    return now


def _ritz(fit: _Fit, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, their vectors, and V times these."""
    q, _ = np.linalg.qr(block)
    q, _ = np.linalg.qr(q)
    vq = fit.times(q)
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def eigenpairs(fit: _Fit, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of V, at most ``k`` that are not 0, and their unit vectors as columns."""
    rng = np.random.default_rng(1)
    width = min(fit.dims, GUARD * k)
    low = _least(fit, rng) if width < fit.dims else 0.0
    value, q, vq = _ritz(fit, rng.standard_normal((fit.dims, width)))
    worst = math.inf
    for _ in range(ROUNDS):
        real = int(np.sum(value[:k] > RANK * max(value[0], 0.0))) if value[0] > 0 else 0
        if not real:
            return np.zeros(0), np.zeros((fit.dims, 0))
        before, worst = worst, float((np.linalg.norm(vq[:, :real] - q[:, :real] * value[:real], axis=0) / value[:real]).max())
        if worst <= CERTIFIED and (worst > SHRINK * before or width == fit.dims):
            turn = np.sign(q[np.abs(q).argmax(axis=0), range(width)])
            return value[:real], (q * turn)[:, :real]
        cut = float(value[-1])
        if cut - low > RANK * value[0]:
            degree = _degree(float(value[0]), float(value[real - 1]), (low + cut) / 2, (cut - low) / 2)
            block = _filtered(fit, q, vq, low, cut, float(value[0]), degree)
        else:  # all that is left out is alike
            block = vq - low * q
        value, q, vq = _ritz(fit, block)
    raise RuntimeError(f"not certified after {ROUNDS} rounds: residual {worst:.2g}")


def _identity_error(fit: _Fit, value: np.ndarray, vector: np.ndarray) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    if not len(value):
        return 0.0
    centre, scaled = fit.centre(), vector / np.sqrt(value)

    def part(x):
        w = centre(x) @ scaled
        return [w.T @ w, w.sum(axis=0)]

    square, total = _reduced(fit.vectors, part, fit.dims, fit.direct)
    covariance = square / fit.n - np.outer(total / fit.n, total / fit.n)
    return float(np.abs(covariance - np.eye(len(value))).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 of each vector, exact; None where it is beyond a long."""
    whole = [s // n for s in sums]
    rest = [s - w * n for s, w in zip(sums, whole, strict=True)]
    off = x - np.array(whole, np.int64)
    most = int(np.abs(off).max(initial=0)) * n + n
    if most * most * x.shape[1] < 1 << 63:
        return (np.square(off * n - np.array(rest, np.int64)).sum(axis=1)).tolist()
    exact = [sum((int(v) * n - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in off.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def _project(fit: _Fit, vector: np.ndarray, value: np.ndarray, explained: list[float], error: float):
    dims, n, sums, centre, k = fit.dims, fit.n, fit.sums, fit.centre(), len(value)
    root = np.sqrt(value)

    def run(batches):
        for batch in batches:
            ok, x = _usable(batch.column(1), dims)
            rows = len(x)
            ids = batch.column(0).filter(pa.array(ok)).take(pa.array(np.repeat(np.arange(rows), k)))
            deviation = pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)), deviation,
                 pa.array((centre(x) @ vector / root).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                [c.split()[0] for c in WHITENED.split(", ")])

    return run


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row of ``table`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Usable are vectors without null or non-finite entries (an entry whose 64-fold is beyond 2**62 counts as such) that have as
    many entries as most of them (of equally many, the longer).  x = floor(64 * c) + 1000000; ``n`` distinct x with sums S give
    the covariance V.  Components are its unit eigenvectors, from 1 by falling eigenvalue e, at most ``components``, those with
    e above 0 (RANK of the largest); of each vector the entry of largest size is positive.  ``whitened`` is x - S / n on the
    component over sqrt(e), ``explained`` e / trace(V), ``deviation`` the exact sum of (n * x - S)^2 (null beyond a long),
    ``identity_error`` how far the whitened fit list's covariance is from the identity.  Repeated rows and absent ids are
    rows like any.  Without two distinct usable vectors the result is empty.  Other columns are not read.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = rows.filter(F.forall("vector", lambda c: F.coalesce(F.abs(c) * SCALE < MOST, F.lit(False))) & (F.size("vector") > 0))
    lengths = whole.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], WHITENED)
    dims = lengths[0].dims
    vectors = write_out(map_batches(rows.select("vector"), _integers(dims), "x binary").distinct(), "vectors")
    fit = _fit(vectors, dims)
    value, vector = eigenpairs(fit, min(components, dims)) if fit.n > 1 else (np.zeros(0), np.zeros((dims, 0)))
    trace = fit.trace() if len(value) else 1.0
    return map_batches(rows, _project(fit, vector, value, [float(e) / trace for e in value], _identity_error(fit, value, vector)), WHITENED)
