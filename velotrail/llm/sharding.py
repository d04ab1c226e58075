"""Sharding along a Hilbert curve over several quantised metadata columns.

Each dimension becomes a cell number of ``bits`` bits: numbers by approximate quantiles, texts by hash.  Rows are ordered
by the cell's place on the curve and cut into runs, so a shard is a compact region and a filter on any of the dimensions
leaves out most files.  Only the dimensions and keys are sorted, not the texts; everything is built-in functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from velotrail.llm.tables import write_out

BITS = 4
#: Relative accuracy of the quantiles is 1 over this.
ACCURACY = 1000


def hilbert_index(cells: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """Add the place of each cell on the Hilbert curve; axes are columns with numbers below 2**bits (replaced).

    The usual transposition: undo the excess work of the rotations bit by bit, Gray-code, then interleave the bits.
    """
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for k, axis in enumerate(axes):
            first, own = F.col(axes[0]), F.col(axis)
            turned = own.bitwiseAND(F.lit(q)) != 0
            if not k:
                cells = cells.withColumn(axis, F.when(turned, own.bitwiseXOR(F.lit(low))).otherwise(own))
                continue
            swap = first.bitwiseXOR(own).bitwiseAND(F.lit(low))
            cells = cells.withColumns({axes[0]: F.when(turned, first.bitwiseXOR(F.lit(low))).otherwise(first.bitwiseXOR(swap)),
                                       axis: F.when(turned, own).otherwise(own.bitwiseXOR(swap))})
        q >>= 1
    gray, last = {}, F.lit(0)
    for axis in axes:
        last = last.bitwiseXOR(F.col(axis))
        gray[axis] = last
    cells = cells.withColumns(gray)
    end = F.col(axes[-1])
    fix = reduce(Column.bitwiseXOR, [F.when(end.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)) for b in range(1, bits)], F.lit(0))
    cells = cells.withColumn(name, fix).withColumns({a: F.col(a).bitwiseXOR(F.col(name)) for a in axes})
    n = len(axes)
    place = [F.shiftleft(F.shiftright(F.col(a), b).bitwiseAND(F.lit(1)).cast("long"), b * n + n - 1 - k)
             for b in range(bits) for k, a in enumerate(axes)]
    return cells.withColumn(name, reduce(Column.bitwiseOR, place))


def _cells(rows: DataFrame, dims: list[str], bits: int) -> dict[str, Column]:
    """Cell number of each dimension; absent values lie in cell 0."""
    numbers = [d for d in dims if isinstance(rows.schema[d].dataType, NumericType)]
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = rows.agg(*[F.percentile_approx(F.col(d).cast("double"), cuts, ACCURACY).alias(d) for d in numbers]).first() if numbers else None
    out = {}
    for d in dims:
        if d in numbers:
            steps = sorted(set(found[d] or []))
            cell = reduce(Column.__add__, [F.when(F.col(d) > s, 1).otherwise(0) for s in steps], F.lit(0))
        else:
            cell = F.pmod(F.xxhash64(F.col(d).cast("string")), F.lit(1 << bits)).cast("int")
        out[d] = F.when(F.col(d).isNull(), 0).otherwise(cell)
    return out


def hilbert_shards(rows: DataFrame, dims: list[str], ties: list[str], shards: int = 24, law: str = "rows", size_col: str | None = None,
                   bits: int = BITS) -> DataFrame:
    """``rows`` with shard (0 to shards - 1) and slot (gapless from 0 in each shard, along the curve).

    ``law`` 'rows' makes the numbers of rows at most one apart; 'bytes' cuts where the running sum of ``size_col`` passes
    equal shares, so shards differ by at most one row's size on either end.  ``ties`` order the rows of one cell; rows alike
    in them get any order.  Absent values count as cell 0 and come first.  An empty table gives an empty result; columns named
    shard or slot are replaced.
    """
    if bits * len(dims) > 62:
        raise ValueError(f"{len(dims)} dimensions of {bits} bits don't fit the curve's index")
    rows = rows.drop("shard", "slot")
    own = rows.columns
    mark = "_" * (1 + max(len(c) for c in own))  # no column has this name or one that begins with it
    place, part, at, size, rank, run = (mark + x for x in ("place", "part", "at", "size", "rank", "run"))
    axes = [f"{mark}axis{k}" for k in range(len(dims))]
    cells = rows.withColumns(dict(zip(axes, _cells(rows, dims, bits).values(), strict=True)))
    placed = hilbert_index(cells, axes, bits, place).drop(*axes)
    order = [place, *ties]
    # The row number in a partition is the low part of the id.
    table = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
        {part: F.spark_partition_id(), at: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    table = write_out(table.withColumn(size, F.col(size_col).cast("long") if size_col else F.lit(1).cast("long")), "curve")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = table.groupBy(part).agg(F.count("*").alias("n"), F.sum(size).alias("s"))
    # One row for each partition.
    bases = sums.select(part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{mark}{c}_before") for c in ("n", "s")],
                        *[F.sum(c).over(whole).alias(f"{mark}{c}_all") for c in ("n", "s")])
    ranked = table.join(F.broadcast(bases), part).withColumn(rank, F.col(f"{mark}n_before") + F.col(at))
    if law == "rows":
        first = F.expr(f"(shard * {mark}n_all + {shards} - 1) div {shards}")
        return (ranked.withColumn("shard", F.expr(f"({rank} * {shards}) div {mark}n_all").cast("int"))
                .withColumn("slot", F.col(rank) - first).select(*own, "shard", "slot"))
    running = F.col(f"{mark}s_before") + F.sum(size).over(
        Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size)
    ranked = ranked.withColumn(run, running).withColumn(
        "shard", F.least(F.lit(shards - 1), F.expr(f"(({run} + {size} div 2) * {shards}) div greatest({mark}s_all, 1)")).cast("int"))
    ranked = write_out(ranked, "cut")
    firsts = ranked.groupBy("shard").agg(F.min(rank).alias(f"{mark}first"))
    return ranked.join(F.broadcast(firsts), "shard").withColumn("slot", F.col(rank) - F.col(f"{mark}first")).select(*own, "shard", "slot")


def write_shards(docs: DataFrame, path: str, dims: list[str], ties: list[str], shards: int = 24, bits: int = BITS) -> None:
    """Write whole rows as one folder for each shard, each sorted along the curve.

    Columns named shard or slot are left out; whatever other names and nulls there are stay.  An empty table gives no files.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    placed = hilbert_shards(docs, dims, ties, shards, bits=bits)
    placed.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot").select(*own, "shard").write.partitionBy("shard").parquet(path)
