"""Delay and throughput reports.  The read clock is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velotrail.functions.text import whole_parts
from velotrail.plans.ranks import group_rank, table_rank

DELAYS = ("send_to_write", "write_to_read", "send_to_read")


def delays(track: DataFrame, now_ms: int | Column) -> DataFrame:
    """Sent -> written, written -> read, sent -> read, in ms."""
    now = F.lit(now_ms).cast("bigint") if isinstance(now_ms, int) else now_ms
    sent, written = F.col("event_ms"), F.col("arrival_ms")
    return track.withColumns({"send_to_write": written - sent, "write_to_read": now - written, "send_to_read": now - sent})


def delay_report(track: DataFrame, now_ms: int, every: int = 100, hot_rows: int | None = None) -> DataFrame:
    """Average delays of each complete group of ``every`` samples of a vehicle, in arrival order.

    ``avg_*`` is rounded down, ``mean_*`` is exact; an incomplete last group is left out.
    """
    samples = delays(track, now_ms).select("vehicle_id", "arrival_ms", "line", *DELAYS)
    ranked = group_rank(
        samples, ["vehicle_id"], [F.col("arrival_ms"), F.col("line")], "_rank", hot_rows=hot_rows
    )
    grouped = ranked.withColumn("group_no", whole_parts(F.col("_rank"), every)).groupBy("vehicle_id", "group_no").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(d).alias(d) for d in DELAYS]
    ).filter(F.col("n") == every)
    return grouped.select(
        "vehicle_id", "group_no", "n",
        *[whole_parts(F.col(d), every).alias(f"avg_{d}") for d in DELAYS],
        *[(F.col(d) / every).alias(f"mean_{d}") for d in DELAYS],
    )


def batch_latency(track: DataFrame, now_ms: int | Column) -> DataFrame:
    """Count, total and average of (now - sent): one row, or none for an empty batch.

    Sums are DOUBLE: a LONG total of milliseconds would overflow on the full data.
    """
    now = F.lit(now_ms).cast("bigint") if isinstance(now_ms, int) else now_ms
    late = (now - F.col("event_ms")).cast("double")
    return track.agg(
        F.count(F.lit(1)).alias("n"), F.sum(late).alias("total_ms"), F.avg(late).alias("avg_ms")
    ).filter(F.col("n") > 0)


def progress_marks(
    records: DataFrame, every: int = 100_000, order: list[str] | None = None,
    by: str | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """Each ``every``-th record in order of ``order``: running count and time, in all or per ``by``."""
    order = order or ["arrival_ms", "line"]
    columns = [F.col(c) for c in order]
    if by:
        ranked = group_rank(records.select(by, *order), [by], columns, "_rank", hot_rows=hot_rows)
    else:
        ranked, _ = table_rank(records.select(*order), columns, "_rank")
    marks = ranked.withColumn("running_count", F.col("_rank") + 1).filter(F.col("running_count") % every == 0)
    return marks.select(*([by] if by else []), "running_count", order[0])


def throughput(records: DataFrame, time: str = "arrival_ms") -> DataFrame:
    """Total records, first and last time, records per second."""
    totals = records.agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("first_ms"), F.max(time).alias("last_ms")
    )
    seconds = (F.col("last_ms") - F.col("first_ms")) / F.lit(1000.0)
    return totals.withColumn("records_per_s", F.when(seconds > 0, F.col("n") / seconds))
