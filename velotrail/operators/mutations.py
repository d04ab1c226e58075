"""Changes to a cells frame: puts, deletes, counters, appends, retention.

Each function returns the changed frame; untouched cells are passed through by a filter or
by joins with the (usually small) batch of changes.  "Now" is an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.functions.text import whole_parts
from velotrail.operators.cells import CELL, CELLS, VERSION, newest, restrict, versions
from velotrail.plans.ranks import group_rank
from velotrail.plans.skew import is_small, shuffled, skew_join

ROW_FAMILY = ["row_key", "family"]
CHUNK = 1000
DELETE_KINDS = ("row", "family", "columns", "column")


def upsert(cells: DataFrame, new: DataFrame, small_side: bool | None = None) -> DataFrame:
    """Cells with the versions in ``new`` (unique) added or replaced."""
    kept = skew_join(cells, new.select(*VERSION), VERSION, "left_anti", small_side=small_side, skewed=False)
    return kept.select(*CELLS).unionByName(new.select(*CELLS))


def put_cells(cells: DataFrame, puts: DataFrame, now_ms: int) -> DataFrame:
    """Upsert; the time is that of the cell (``ts``), else of the put (``put_ts``), else now."""
    return upsert(cells, stamped_puts(puts, now_ms), is_small(puts))


def stamped_puts(puts: DataFrame, now_ms: int) -> DataFrame:
    """The versions that a batch of puts sets; of several values for one, the largest."""
    times = [F.col(c) for c in ("ts", "put_ts") if c in puts.columns]
    stamped = puts.withColumn("ts", F.coalesce(*times, F.lit(now_ms).cast("bigint")))
    return stamped.groupBy(*VERSION).agg(F.max("value").alias("value"))


def mutate_rows(cells: DataFrame, mutations: DataFrame, ts: int, small_side: bool | None = None) -> DataFrame:
    """Apply puts and deletes (``op``) in ``seq`` order, all with the time ``ts``.

    A delete removes all versions up to ``ts`` of the cell, or of the family if its qualifier
    is null; a put sets the version at ``ts``.  Only the last put behind the last delete of a
    cell is left, so each cell's changes fold into one row before anything is joined.
    """
    small = is_small(mutations) if small_side is None else small_side
    judged, per_family = folded_mutations(mutations, small)
    at = F.lit(ts).cast("bigint")
    marks = judged.select(*CELL, "_deleted", "_put")
    marked = skew_join(cells, marks, CELL, "left", small_side=small)
    marked = skew_join(marked, per_family, ROW_FAMILY, "left", small_side=small)
    gone = (
        (F.coalesce(F.col("_deleted"), F.lit(False)) | F.col("_family_seq").isNotNull()) & (F.col("ts") <= at)
    ) | (F.coalesce(F.col("_put"), F.lit(False)) & (F.col("ts") == at))
    new = judged.filter("_put").select(*CELL, at.alias("ts"), F.col("_last.value").alias("value"))
    return marked.filter(~gone).select(*CELLS).unionByName(new)


def folded_mutations(mutations: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """One row per cell (_last, _deleted, _put: whether its last put stands) and one per family that is deleted."""
    delete = F.col("op") == "delete"
    per_cell = mutations.filter(F.col("qualifier").isNotNull()).groupBy(*CELL).agg(
        F.max(F.struct("seq", "op", "value")).alias("_last"), F.max(delete).alias("_deleted")
    )
    per_family = mutations.filter(F.col("qualifier").isNull() & delete).groupBy(*ROW_FAMILY).agg(
        F.max("seq").alias("_family_seq")
    )
    judged = skew_join(per_cell, per_family, ROW_FAMILY, "left", small_side=small).withColumn(
        "_put",
        (F.col("_last.op") == "put")
        & (F.col("_family_seq").isNull() | (F.col("_last.seq") > F.col("_family_seq"))),
    )
    return judged, per_family


def increment_cells(cells: DataFrame, increments: DataFrame, now_ms: int) -> tuple[DataFrame, DataFrame]:
    """Add amounts (default 1) to counters, a missing one counts as 0: (cells, new values).

    The new version is at ``now_ms``, or at the stored version's time if that is later, so that it is the newest.
    """
    sums = summed(increments)
    small = is_small(sums)
    stored = newest(restrict(cells, sums, CELL, small)).select(*CELL, F.col("ts").alias("_at"), F.col("value").alias("_old"))
    number = F.col("_old").try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit("no counter: "), F.col("_old"))).cast("bigint")
    old = F.when(F.col("_old").isNull(), F.lit(0).cast("bigint")).when(number.isNull(), bad).otherwise(number)
    new = sums.join(shuffled(stored, small), CELL, "left").select(
        *CELL, _not_before(now_ms), (old + F.col("_sum")).cast("string").alias("value")
    )
    return upsert(cells, new, small), new.select(*CELL, F.col("value").cast("bigint").alias("value"))


def summed(increments: DataFrame) -> DataFrame:
    """The sum of the amounts (default 1) of each cell."""
    amount = F.coalesce(F.col("amount"), F.lit(1)) if "amount" in increments.columns else F.lit(1)
    return increments.groupBy(*CELL).agg(F.sum(amount.cast("bigint")).alias("_sum"))


def _not_before(now_ms: int) -> Column:
    return F.greatest(F.lit(now_ms).cast("bigint"), F.col("_at")).alias("ts")


def append_cells(
    cells: DataFrame, appends: DataFrame, now_ms: int, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame]:
    """Join values to cells in ``seq`` order: (cells, new values), at the time that counters get too."""
    added = joined_values(appends, chunk)
    small = is_small(appends)
    stored = newest(restrict(cells, appends, CELL, small)).select(*CELL, F.col("ts").alias("_at"), F.col("value").alias("_old"))
    new = added.join(shuffled(stored, small), CELL, "left").select(
        *CELL, _not_before(now_ms),
        F.concat(F.coalesce("_old", F.lit("")), "_added").alias("value"),
    )
    return upsert(cells, new, small), new.select(*CELL, "value")


def joined_values(appends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The values of each cell joined in ``seq`` order.

    Values are joined in runs of ``chunk`` first, so a cell with very many appends is worked
    on by many tasks and only its runs meet at the end.
    """
    ranked = group_rank(appends.select(*CELL, "seq", "value"), CELL, [F.col("seq")], "_rank")
    runs = ranked.withColumn("_run", whole_parts(F.col("_rank"), chunk)).groupBy(*CELL, "_run").agg(
        _in_order("seq", "value").alias("_text")
    )
    return runs.groupBy(*CELL).agg(_in_order("_run", "_text").alias("_added"))


def _in_order(order: str, value: str) -> Column:
    pairs = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.array_join(F.transform(pairs, lambda p: p[value]), "")


def delete_column(cells: DataFrame, requests: DataFrame, ts: int | None = None) -> DataFrame:
    """Remove all versions of the requested cells, or those up to ``ts``."""
    return _delete_by(cells, requests, CELL, ts)


def delete_row(cells: DataFrame, keys: DataFrame, ts: int | None = None) -> DataFrame:
    """Remove all cells of the rows, or those up to ``ts``."""
    return _delete_by(cells, keys, ["row_key"], ts)


def _delete_by(cells: DataFrame, requests: DataFrame, keys: list[str], ts: int | None) -> DataFrame:
    asked = requests.select(*keys).distinct()
    if ts is None:
        return skew_join(cells, asked, keys, "left_anti").select(*CELLS)
    marked = skew_join(cells, asked.withColumn("_asked", F.lit(True)), keys, "left")
    return marked.filter(F.col("_asked").isNull() | (F.col("ts") > ts)).select(*CELLS)


def delete_typed(cells: DataFrame, deletes: DataFrame, now_ms: int | None = None) -> DataFrame:
    """Deletes of a named ``kind``, all judged on the table as it was before the batch:

    row / family / columns: every version up to ``ts``; column: the version at ``ts``, or the
    newest one if ``ts`` is null.  Without a time the first three take ``now_ms`` (None: all).
    """
    small = is_small(deletes)
    known = F.coalesce(F.col("kind").isin(*DELETE_KINDS), F.lit(False))
    strange = deletes.filter(~known).select("kind").first()
    if strange:
        raise ValueError(f"unknown kind of delete: {strange.kind}")
    forever = F.lit(now_ms if now_ms is not None else (1 << 63) - 1).cast("bigint")
    out = cells
    for kind, keys in (("row", ["row_key"]), ("family", ROW_FAMILY), ("columns", CELL)):
        cut = deletes.filter(F.col("kind") == kind).groupBy(*keys).agg(
            F.max(F.coalesce("ts", forever)).alias("_cut")
        )
        marked = skew_join(out, cut, keys, "left", small_side=small)
        out = marked.filter(F.col("_cut").isNull() | (F.col("ts") > F.col("_cut"))).select(*CELLS)
    single = deletes.filter(F.col("kind") == "column")
    last = newest(restrict(cells, single.filter(F.col("ts").isNull()), CELL, small)).select(*VERSION)
    exact = single.filter(F.col("ts").isNotNull()).select(*VERSION).unionByName(last).distinct()
    return skew_join(out, exact, VERSION, "left_anti", small_side=small, skewed=False).select(*CELLS)


def retain_versions(cells: DataFrame, n: int = 3, hot_rows: int | None = None) -> DataFrame:
    """The newest ``n`` versions of every cell."""
    return versions(cells, n, hot_rows)


def expire_ttl(cells: DataFrame, ttl_s: int, now_ms: int) -> DataFrame:
    """Drop cells older than ``ttl_s`` seconds: a filter that reaches the files."""
    return cells.filter(F.col("ts") >= now_ms - ttl_s * 1000)
