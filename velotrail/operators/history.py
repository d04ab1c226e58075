"""History of positions: one row per ``id@time``, newest write wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.functions import text
from velotrail.operators.parse import FIELDS, parse_line
from velotrail.plans.ranks import table_rank
from velotrail.plans.skew import match, top_n

HISTORY = ("row_key", "vehicle_id", "event_ms", *FIELDS, "arrival_ms")


def bucket_of(vehicle_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(vehicle_id), F.lit(buckets)).cast("int")


def history_rows(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """Lines with an arrival stamp -> history rows, not yet deduplicated."""
    parsed = parse_line(lines, mode=mode, split_key=False)
    good = parsed if mode == "strict" else parsed[0]
    vehicle, time = text.split_key(F.col("row_key"))
    return good.select(
        "row_key", vehicle.alias("vehicle_id"), time.try_cast("bigint").alias("event_ms"),
        *FIELDS, "arrival_ms",
    )


def newest_rows(history: DataFrame) -> DataFrame:
    """One row per key: the larger (arrival_ms, line) wins.

    An aggregate and not a window, so copies collapse before the shuffle.  The columns that
    follow from the key are grouped too, so that filters on them pass below.
    """
    follow = [c for c in ("row_key", "vehicle_id", "event_ms", "bucket") if c in history.columns]
    line = F.concat_ws(",", "row_key", *FIELDS).alias("line")
    best = history.groupBy(*follow).agg(F.max(F.struct("arrival_ms", line, *FIELDS)).alias("_w"))
    wide = best.select(*follow, *[F.col("_w")[c].alias(c) for c in (*FIELDS, "arrival_ms")])
    return wide.select(*HISTORY, *[c for c in follow if c == "bucket"])


def track_history(
    history: DataFrame,
    ids: Sequence[str] | DataFrame | None = None,
    mode: str = "exact",
    buckets: int | None = None,
) -> DataFrame:
    """Points of vehicles in key order.

    ``ids``: None = every vehicle; a list; or a frame (pos, vehicle_id) answered in the order
    of ``pos``.  ``mode='bytes'`` scans ``[id@000000, (id+1)@000000)`` by bytes, which also
    finds longer ids and misses some (9 -> 10).  With ``buckets`` a list of ids reads only
    their partitions.
    """
    if mode not in ("exact", "bytes"):
        raise ValueError(f"mode must be 'exact' or 'bytes', not {mode!r}")
    if isinstance(ids, DataFrame):
        found = match(history, ids, ["vehicle_id"]) if mode == "exact" else _in_byte_ranges(history, ids)
        return found.orderBy("pos", "row_key")
    if ids is None:
        return history.orderBy("row_key")
    if mode == "bytes":
        wanted = F.lit(False)
        for i in ids:
            low, high = byte_range(i)
            wanted = wanted | ((F.col("row_key") >= low) & (F.col("row_key") < high))
        return history.filter(wanted).orderBy("row_key")
    found = history.filter(F.col("vehicle_id").isin(list(ids)))
    if buckets and "bucket" in history.columns:
        found = found.filter(F.col("bucket").isin([bucket_of(F.lit(i), buckets) for i in ids]))
    return found.orderBy("row_key")


def byte_range(vehicle_id: str) -> tuple[str, str]:
    """Start and stop key of one vehicle's range scan."""
    return f"{vehicle_id}@000000", f"{int(vehicle_id) + 1}@000000"


def _in_byte_ranges(history: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of each requested range, by an equality join on the few ids whose range can hold a key."""
    following = (F.col("vehicle_id").cast("decimal(38,0)") + 1).cast("decimal(38,0)").cast("string")
    ranges = ids.select(
        "pos", F.col("vehicle_id").alias("_id"), F.concat("vehicle_id", F.lit("@000000")).alias("_start"),
        F.concat(following, F.lit("@000000")).alias("_stop"),
    ).filter("_start < _stop")
    plain = F.col("_id").rlike("^[1-9][0-9]*$")
    near = _by_neighbours(history, ranges.filter(plain))
    return near.unionByName(_by_shared_prefix(history, ranges.filter(~plain))).drop("_id", "_start", "_stop")


def _inside(met: DataFrame) -> DataFrame:
    return met.filter((F.col("row_key") >= F.col("_start")) & (F.col("row_key") < F.col("_stop")))


def _nothing(history: DataFrame, ranges: DataFrame) -> DataFrame:
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in ranges.schema.fields]
    return history.select("*", *columns).filter(F.lit(False))


def _by_neighbours(history: DataFrame, ranges: DataFrame) -> DataFrame:
    """For ids without leading zeros: a key lies between an id of w digits and the next one only if the first w characters
    are one of the two, or lie between them in byte order.  That leaves two ids for each width."""
    widths = sorted(r[0] for r in ranges.select(F.length("_id")).distinct().collect())  # no more than an id has digits
    if not widths:
        return _nothing(history, ranges)
    found = []
    for w in widths:
        first = F.substring("row_key", 1, w)
        digits = F.regexp_extract(first, "^[0-9]*", 0)
        after = F.substring("row_key", F.length(digits) + 1, F.lit(1))
        own = digits.cast("decimal(38,0)")
        below = (F.rpad(digits, w, "0").cast("decimal(38,0)") - 1).cast("decimal(38,0)").cast("string")
        found.append(
            F.when(F.length(digits) == w, F.array(digits, (own - 1).cast("decimal(38,0)").cast("string")))
            .when(after > "9", F.array(F.rpad(digits, w, "9"))).otherwise(F.array(below))
        )
    rows = history.withColumn("_id", F.explode(F.array_distinct(F.flatten(F.array(*found)))))
    return _inside(match(rows, ranges, ["_id"]))


def _by_shared_prefix(history: DataFrame, ranges: DataFrame) -> DataFrame:
    """For other ids, whose ranges may be wide: an equality join on the text that the two ends share.

    Every key between two keys begins with their common prefix, so a row only meets the requests whose prefix it has.
    """
    shared = F.size(F.filter(
        F.sequence(F.lit(1), F.length("_start")),
        lambda i: F.substring("_start", F.lit(1), i) == F.substring("_stop", F.lit(1), i),
    ))
    ranges = ranges.withColumn("_shared", shared).withColumn("_prefix", F.substring("_start", F.lit(1), F.col("_shared")))
    lengths = sorted(r[0] for r in ranges.select("_shared").distinct().collect())
    if not lengths:
        return _nothing(history, ranges.drop("_shared", "_prefix"))
    rows = history.withColumn("_shared", F.explode(F.lit(lengths))).withColumn(
        "_prefix", F.substring("row_key", F.lit(1), F.col("_shared"))
    )
    return _inside(match(rows, ranges, ["_shared", "_prefix"])).drop("_shared", "_prefix")


def page(rows: DataFrame, n: int, after: str | None = None, key: str = "row_key") -> DataFrame:
    """The next ``n`` rows behind key ``after``; an empty page ends the scan.

    First the page's last key is found among the keys alone; then only rows up to it are settled and sorted, however many follow.
    """
    rest = rows if after is None else rows.filter(F.col(key) > after)
    last = rest.select(key).orderBy(key).limit(n).agg(F.max(key)).first()[0]
    rest = rest.filter(F.lit(False) if last is None else F.col(key) <= last)
    return rest.orderBy(key).limit(n)


def page_numbers(rows: DataFrame, n: int, key: str = "row_key") -> DataFrame:
    """All pages at once: each row with the number of the page of ``n`` rows it falls on."""
    ranked, _ = table_rank(rows, [F.col(key)], "_rank")
    return ranked.withColumn("page_no", text.whole_parts(F.col("_rank"), n)).drop("_rank")


def last_of_first_n(history: DataFrame, n: int = 100) -> DataFrame:
    """Per vehicle: the last of the first ``n`` rows in key order (not the newest row)."""
    first = top_n(history, ["vehicle_id"], [F.col("row_key")], n)
    rest = [c for c in history.columns if c not in ("vehicle_id", "row_key")]
    last = first.groupBy("vehicle_id").agg(F.max(F.struct("row_key", *rest)).alias("_w"))
    return last.select("vehicle_id", "_w.*")
