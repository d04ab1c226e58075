"""Ranks and running totals over groups that may be as large as the table.

A window over a hot key would sort the whole key in one task.  For hot keys (and for
ranks over the whole table) the rows are range-partitioned by key and order columns,
so that one key spreads over many sorted partitions, and written once to the shared
folder.  A second pass adds what lies in earlier partitions; that is one row per
partition and hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velotrail.plans import skew
from velotrail.plans.scratch import write_out
from velotrail.plans.skew import PIECES, flag_hot, hot_keys

_PART = "_part"
_PLACE = "_place"
# monotonically_increasing_id keeps the partition above bit 33 and the row below it.
_ROW_BITS = 33


def _sorted_table(df: DataFrame, order: Sequence[Column], label: str, parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted, with the partition and the place in it as columns.

    Rows that are equal in ``order`` follow their content.  Copies of one row get a running
    number, so that very many copies spread too; which copy gets which does not matter.
    """
    told_apart = df.withColumns({"_content": F.xxhash64(*df.columns), "_copy": F.monotonically_increasing_id()})
    full = [*order, F.col("_content"), F.col("_copy")]
    ranged = told_apart.repartitionByRange(parts or _ranges(df, df.count()), *full)
    placed = ranged.sortWithinPartitions(*full).drop("_content", "_copy").withColumn("_id", F.monotonically_increasing_id())
    return write_out(
        placed.withColumn(_PART, F.shiftright("_id", _ROW_BITS).cast("int"))
        .withColumn(_PLACE, F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id"),
        label,
    )


def _ranges(df: DataFrame, rows: int) -> int:
    """Ranges of at most about HOT_ROWS rows, and as many as other shuffles have."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // skew.HOT_ROWS))


def table_rank(
    df: DataFrame, order: Sequence[Column], rank: str = "rank", parts: int | None = None
) -> tuple[DataFrame, int]:
    """Rank (from 0) of each row in the whole table, and the number of rows."""
    table = _sorted_table(df, order, "rank", parts)
    sizes = sorted(table.groupBy(_PART).count().collect())  # one row per partition
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts, f"{_PART} int, _start bigint")
    ranked = table.join(F.broadcast(offsets), _PART).withColumn(rank, F.col("_start") + F.col(_PLACE))
    return ranked.drop(_PART, _PLACE, "_start"), total


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
    size: str | None = None,
    sums: Mapping[str, Column] | None = None,
    hot_rows: int | None = None,
    count_in: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Rank (from 0) in the key's group; optionally the group size and sums over earlier rows.

    ``sums`` maps a new column name to a number; the column holds the total of the rows
    before this one (0 for the first).  ``count_in`` is a frame with the same keys that is
    cheaper to count than ``df``.
    """
    keys = list(keys)
    measures = dict(sums or {})
    work = df
    for name, value in measures.items():
        work = work.withColumn(f"_m_{name}", value)
    hot = hot_keys(df if count_in is None else count_in, keys, hot_rows)
    if hot is None:
        return _in_window(work, keys, order, rank, size, measures)
    marked = flag_hot(work, keys, hot)
    cold = _in_window(marked.filter(~F.col("_hot")).drop("_hot"), keys, order, rank, size, measures)
    hot_parts = parts or _ranges(df, hot.agg(F.sum(PIECES)).first()[0] * (skew.HOT_ROWS if hot_rows is None else hot_rows))
    spread = _spread(marked.filter(F.col("_hot")).drop("_hot"), keys, order, rank, size, measures, hot_parts)
    return cold.unionByName(spread)


def _in_window(df, keys, order, rank, size, measures) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn(rank, F.row_number().over(ordered).cast("bigint") - 1)
    if size:
        out = out.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    for name in measures:
        out = out.withColumn(name, F.coalesce(F.sum(f"_m_{name}").over(before), F.lit(0)))
    return out.drop(*[f"_m_{m}" for m in measures])


def _spread(df, keys, order, rank, size, measures, parts) -> DataFrame:
    table = _sorted_table(df, [*[F.col(k) for k in keys], *order], "group-rank", parts)
    # At most (partitions + hot keys) rows: a key is in several partitions only at their borders.
    totals = table.groupBy(*keys, _PART).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(_PLACE).alias("_r_first"),
        *[F.sum(f"_m_{m}").alias(f"_t_{m}") for m in measures],
    )
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(_PART).alias("_r_part"),
        "_r_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_r_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_r_size"),
        *[F.coalesce(F.sum(f"_t_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures],
    )
    same = F.col(_PART) == F.col("_r_part")
    for k in keys:
        same = same & table[k].eqNullSafe(F.col(f"_k_{k}"))
    out = table.join(F.broadcast(offsets), same).withColumn(
        rank, F.col("_r_before") + F.col(_PLACE) - F.col("_r_first")
    )
    if size:
        out = out.withColumn(size, F.col("_r_size"))
    local = Window.partitionBy(*keys, _PART).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, -1)
    for m in measures:
        out = out.withColumn(m, F.col(f"_o_{m}") + F.coalesce(F.sum(f"_m_{m}").over(local), F.lit(0)))
    return out.drop(
        _PART, _PLACE, "_r_part", "_r_first", "_r_before", "_r_size",
        *[f"_k_{k}" for k in keys], *[f"_o_{m}" for m in measures], *[f"_m_{m}" for m in measures],
    )
