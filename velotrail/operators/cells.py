"""Reads of versioned wide-column cells.

A cells frame has row_key, family, qualifier, ts, value and is unique on the first four.
Requests come as a frame, so one call serves many rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.functions.text import whole_parts
from velotrail.plans.ranks import group_rank
from velotrail.plans.scratch import write_out
from velotrail.plans.skew import is_small, match, skew_join, top_n

CELL = ["row_key", "family", "qualifier"]
VERSION = [*CELL, "ts"]
CELLS = [*VERSION, "value"]

_LITERAL = re.compile(r"[\w-]*\Z")


def column_filter(columns: Sequence[str] | None, regex: bool = False) -> Column:
    """True for cells of the chosen columns, given as ``family`` or ``family:qualifier``.

    With ``regex`` a qualifier may be a pattern that has to match the whole qualifier.
    """
    if columns is None:
        return F.lit(True)
    chosen = F.lit(False)
    for name in columns:
        family, colon, qualifier = name.partition(":")
        one = F.col("family") == family
        if colon and qualifier:
            if regex and not _LITERAL.match(qualifier):
                one = one & F.col("qualifier").rlike(f"^(?:{qualifier})$")
            else:
                one = one & (F.col("qualifier") == qualifier)
        chosen = chosen | one
    return chosen


def at_time(cells: DataFrame, ts: int | None, at: str = "exact") -> DataFrame:
    """Cells with ``ts = t`` (exact) or ``ts <= t`` (as_of)."""
    if at not in ("exact", "as_of"):
        raise ValueError(f"at must be 'exact' or 'as_of', not {at!r}")
    if ts is None:
        return cells
    return cells.filter(F.col("ts") == ts if at == "exact" else F.col("ts") <= ts)


def newest(cells: DataFrame) -> DataFrame:
    """The newest version of each cell; versions collapse before the shuffle."""
    best = cells.groupBy(*CELL).agg(F.max(F.struct("ts", "value")).alias("_w"))
    return best.select(*CELL, "_w.ts", "_w.value")


def versions(cells: DataFrame, n: int | None, hot_rows: int | None = None) -> DataFrame:
    """The newest ``n`` versions of each cell; None or 0 = all."""
    if not n:
        return cells.select(*CELLS)
    if n == 1:
        return newest(cells)
    return top_n(cells.select(*CELLS), CELL, [F.col("ts").desc()], n, hot_rows=hot_rows)


def restrict(
    cells: DataFrame, requests: DataFrame, keys: Sequence[str], small_side: bool | None = None
) -> DataFrame:
    """Cells that some request asks for."""
    return skew_join(cells, requests.select(*keys).distinct(), keys, "left_semi", small_side=small_side)


def cell_get(cells: DataFrame, requests: DataFrame) -> DataFrame:
    """Newest version of each requested cell; nothing for a missing one."""
    return newest(restrict(cells, requests, CELL))


def cell_versions(
    cells: DataFrame, requests: DataFrame, n: int, ts: int | None = None, at: str = "as_of"
) -> DataFrame:
    """Newest ``n`` versions of each requested cell, optionally at or up to a time."""
    return versions(restrict(at_time(cells, ts, at), requests, CELL), n)


def row_get(
    cells: DataFrame,
    row_keys: str | Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
    ts: int | None = None,
    at: str = "exact",
) -> DataFrame:
    """Newest cells of one row, of several, or (None) of every row."""
    wanted = cells.filter(column_filter(columns))
    if row_keys is not None:
        keys = [row_keys] if isinstance(row_keys, str) else list(row_keys)
        wanted = wanted.filter(F.col("row_key").isin(keys))
    return newest(at_time(wanted, ts, at))


def rows_get(
    cells: DataFrame,
    keys: DataFrame,
    columns: Sequence[str] | None = None,
    ts: int | None = None,
    at: str = "exact",
) -> DataFrame:
    """Newest cells of the rows in ``keys``.  If ``keys`` has a ``ts`` column, each request
    reads its row at that exact time."""
    by = ["row_key", "ts"] if ts is None and "ts" in keys.columns else ["row_key"]
    wanted = restrict(at_time(cells.filter(column_filter(columns)), ts, at), keys, by)
    return wanted.select(*CELLS) if "ts" in by else newest(wanted)


#: Columns of a request that limit what it reads: names as in ``column_filter``, a moment, a time range, versions of a cell.
LIMITS = ("columns", "ts", "min_ts", "max_ts", "n")


def _widest(cells: DataFrame, requests: DataFrame, at: str) -> DataFrame:
    """The cells between the widest time limits of all requests, so that the others are not even read."""
    limits = ("ts", "min_ts", "max_ts")
    wanted = [F.count("*").alias("all")]
    for name in limits:
        if name in requests.columns:
            wanted += [F.count(name).alias(name), F.min(name).alias(f"{name}_low"), F.max(name).alias(f"{name}_high")]
    if len(wanted) == 1:
        return cells
    found = requests.agg(*wanted).first()
    for name in limits:
        if name not in requests.columns or not found["all"] or found[name] < found["all"]:
            continue  # a request without this limit
        if name == "max_ts":
            cells = cells.filter(F.col("ts") < found[f"{name}_high"])
        elif name == "min_ts" or at == "exact":
            cells = cells.filter(F.col("ts") >= found[f"{name}_low"])
        if name == "ts":
            cells = cells.filter(F.col("ts") <= found["ts_high"])
    return cells


def _limited(cells: DataFrame, requests: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """The cells that each request (pos, keys and any of LIMITS, null = no limit) asks for, with its pos."""
    given = [c for c in LIMITS if c in requests.columns]
    cells = _widest(cells, requests, at)
    asked = requests.select("pos", *keys, *[F.col(c).alias(f"_{c}") for c in given])
    met = match(cells.select(*CELLS), asked, keys)
    tests = {
        "columns": lambda c: F.exists(c, lambda x: (x == F.col("family")) | (x == F.concat("family", F.lit(":")))
                                      | (x == F.concat_ws(":", "family", "qualifier"))),
        "ts": lambda c: F.col("ts") == c if at == "exact" else F.col("ts") <= c,
        "min_ts": lambda c: F.col("ts") >= c,
        "max_ts": lambda c: F.col("ts") < c,
    }
    for name in given:
        if name in tests:
            limit = F.col(f"_{name}")
            met = met.filter(limit.isNull() | tests[name](limit))
    return met


def rows_get_ordered(
    cells: DataFrame, requests: DataFrame, columns: Sequence[str] | None = None, at: str = "exact"
) -> DataFrame:
    """For each request (pos, row_key), in order: the row's newest cells, or one row of nulls.

    A request may carry LIMITS of its own; ``n`` gives so many versions of each cell.
    """
    asked = requests.select("pos", "row_key")
    if any(c in requests.columns for c in LIMITS):
        met = _limited(cells.filter(column_filter(columns)), requests, ["row_key"], at)
        hits = _versions_asked(met)
        missing = skew_join(asked, hits.select("pos").distinct(), ["pos"], "left_anti", skewed=False)
        found = cells
    else:
        small = is_small(asked)
        keys = asked.select("row_key").distinct()
        found = newest(skew_join(cells.filter(column_filter(columns)), keys, ["row_key"], "left_semi", small_side=small))
        hits = match(found, asked, ["row_key"], small_side=small)
        missing = skew_join(asked, found.select("row_key").distinct(), ["row_key"], "left_anti", small_side=small)
    nothing = missing.select("*", *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in CELLS[1:]])
    every = hits.select("pos", *CELLS).unionByName(nothing.select("pos", *CELLS))
    return every.orderBy("pos", "family", "qualifier", F.col("ts").desc())


def _versions_asked(met: DataFrame) -> DataFrame:
    """The newest ``_n`` versions (1 if null or not given) of each request's cells."""
    by = ["pos", *CELL]
    if "_n" not in met.columns:
        best = met.groupBy(*by).agg(F.max(F.struct("ts", "value")).alias("_w"))
        return best.select(*by, "_w.ts", "_w.value")
    met = write_out(met, "asked")  # the join is counted and ranked, and must not run twice
    ranked = group_rank(met, by, [F.col("ts").desc()], "_rank")
    return ranked.filter(F.col("_rank") < F.coalesce(F.col("_n"), F.lit(1)))


def cell_versions_ordered(cells: DataFrame, requests: DataFrame, at: str = "as_of") -> DataFrame:
    """For each request (pos and the keys of a cell), in order: its newest ``n`` versions under the request's LIMITS."""
    return _versions_asked(_limited(cells, requests, CELL, at)).select("pos", *CELLS).orderBy("pos", F.col("ts").desc())


def rows_exist(cells: DataFrame, requests: DataFrame, at: str = "exact") -> DataFrame:
    """true/false per request, in order; the key columns in ``requests`` say how fine it asks, LIMITS what counts."""
    keys = [c for c in CELL if c in requests.columns]
    if any(c in requests.columns for c in LIMITS):
        there = _limited(cells, requests, keys, at).select("pos").distinct().withColumn("_there", F.lit(True))
        answered = skew_join(requests, there, ["pos"], "left", skewed=False)
    else:
        small = is_small(requests)
        there = restrict(cells, requests, keys, small).select(*keys).distinct().withColumn("_there", F.lit(True))
        answered = skew_join(requests, there, keys, "left", small_side=small)
    return answered.select(*requests.columns, F.coalesce("_there", F.lit(False)).alias("found")).orderBy("pos")


def time_range(cells: DataFrame, min_ts: int | None = None, max_ts: int | None = None) -> DataFrame:
    """Cells with ``min_ts <= ts < max_ts``."""
    if min_ts is not None:
        cells = cells.filter(F.col("ts") >= min_ts)
    if max_ts is not None:
        cells = cells.filter(F.col("ts") < max_ts)
    return cells


def family_time_range(
    cells: DataFrame, ranges: DataFrame, min_ts: int | None = None, max_ts: int | None = None
) -> DataFrame:
    """A time range per family from (family, min_ts, max_ts), open where null; other families have the general range."""
    limits = ranges.select("family", F.lit(True).alias("_own"), F.col("min_ts").alias("_min"), F.col("max_ts").alias("_max"))
    joined = skew_join(cells, limits, ["family"], "left")

    def inside(low: Column, high: Column) -> Column:
        return (low.isNull() | (F.col("ts") >= low)) & (high.isNull() | (F.col("ts") < high))

    general = inside(F.lit(min_ts).cast("bigint"), F.lit(max_ts).cast("bigint"))
    wanted = F.when(F.col("_own"), inside(F.col("_min"), F.col("_max"))).otherwise(general)
    return joined.filter(wanted).select(*cells.columns)


def scan_range(
    rows: DataFrame, start: str = "", stop: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows with ``start <= row_key < stop`` in byte order; for cells, of the chosen columns.

    A plain filter: it is pushed to the files, where sorted keys let whole blocks be skipped.
    """
    if start:
        rows = rows.filter(F.col("row_key") >= start)
    if stop is not None:
        rows = rows.filter(F.col("row_key") < stop)
    return rows if columns is None else rows.filter(column_filter(columns, regex=True))


def scan(
    cells: DataFrame,
    start: str | None = None,
    stop: str | None = None,
    prefix: str | None = None,
    columns: Sequence[str] | None = None,
    ts: int | None = None,
    at: str = "exact",
    time_limits: tuple[int | None, int | None] | None = None,
    family_limits: DataFrame | None = None,
    max_versions: int | None = 1,
    where: Column | None = None,
    reversed: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Scan in key order from ``start`` (included) to ``stop`` (excluded).

    A ``reversed`` scan goes down, so its start is the larger key.  A timestamp makes the time limits moot; a family with
    limits of its own in ``family_limits`` follows these and not ``time_limits``.  ``where`` is any predicate on a cell and
    is applied before versions are counted.  ``limit`` takes the first so many rows; only cells up to the last of them
    are settled.
    """
    if reversed:
        out = scan_range(cells, columns=columns)
        if start is not None:
            out = out.filter(F.col("row_key") <= start)
        if stop is not None:
            out = out.filter(F.col("row_key") > stop)
    else:
        out = scan_range(cells, start or "", stop, columns)
    if prefix:
        out = out.filter(F.col("row_key").startswith(prefix))
    if ts is not None:
        out = at_time(out, ts, at)
    elif family_limits is not None:
        out = family_time_range(out, family_limits, *(time_limits or (None, None)))
    elif time_limits is not None:
        out = time_range(out, *time_limits)
    if where is not None:
        out = out.filter(where)
    key = F.col("row_key").desc() if reversed else F.col("row_key").asc()
    if limit is not None:
        out = scan_limit(out, limit, reversed)
    return versions(out, max_versions).orderBy(key, "family", "qualifier", F.col("ts").desc())


def scan_limit(scanned: DataFrame, n: int, reversed: bool = False) -> DataFrame:
    """The cells of the first ``n`` rows of a scan.

    The last of these rows is found among the keys alone; what lies behind it is filtered out of the scan before it is settled.
    """
    key = F.col("row_key").desc() if reversed else F.col("row_key").asc()
    first = scanned.select("row_key").distinct().orderBy(key).limit(n)
    edge = first.agg((F.min if reversed else F.max)("row_key")).first()[0]
    return scanned.filter(F.lit(False) if edge is None else F.col("row_key") >= edge if reversed else F.col("row_key") <= edge)


def _row_chunks(cells: DataFrame, batch: int, count_in: DataFrame | None) -> DataFrame:
    """Cells with the number of the result they belong to: at most ``batch`` columns each."""
    order = [F.col("family"), F.col("qualifier"), F.col("ts").desc()]
    ranked = group_rank(cells, ["row_key"], order, "_rank", count_in=count_in)
    return ranked.withColumn("part", whole_parts(F.col("_rank"), batch))


def _entry() -> Column:
    name = F.concat_ws(":", "family", "qualifier").alias("column")
    return F.struct(name, F.struct("value", "ts").alias("cell"))


def _results(cells: DataFrame, batch: int | None, count_in: DataFrame | None, columns: Column) -> DataFrame:
    if batch is None:
        return cells.groupBy("row_key").agg(columns.alias("columns"))
    return _row_chunks(cells, batch, count_in).groupBy("row_key", "part").agg(columns.alias("columns"))


def as_row_map(cells: DataFrame, batch: int | None = None, count_in: DataFrame | None = None) -> DataFrame:
    """One row per key with a map column -> (value, ts); needs one version per column.

    With ``batch`` a row comes as parts (numbered from 0) of so many columns each; without, it is one value, which has to
    fit a task.
    """
    return _results(cells, batch, count_in, F.map_from_entries(F.collect_list(_entry())))


def as_row_list(cells: DataFrame, batch: int | None = None, count_in: DataFrame | None = None) -> DataFrame:
    """One row per key with its columns as a list sorted by name; ``batch`` as for the map."""
    return _results(cells, batch, count_in, F.array_sort(F.collect_list(_entry())))
