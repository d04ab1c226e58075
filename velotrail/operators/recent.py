"""Recent points per vehicle: a set ordered by (score, member)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.functions import text
from velotrail.operators.parse import score_of
from velotrail.plans.ranks import group_rank, table_rank
from velotrail.plans.skew import match, top_n

RECENT = ("vehicle_id", "score", "member", "line", "arrival_ms")


def _ascending():
    return [F.col("score").asc(), F.col("member").asc()]


def _descending():
    return [F.col("score").desc(), F.col("member").desc()]


def recent_set(track: DataFrame, dedup: str = "line") -> DataFrame:
    """Parsed lines -> set members (score = time, member = ``line@arrival``).

    dedup='line': a replayed line stays one member, with its first arrival.
    dedup='member': the same line with another arrival is another member.
    """
    if dedup == "line":
        groups = track.groupBy("vehicle_id", "line").agg(F.min("arrival_ms").alias("arrival_ms"))
    elif dedup == "member":
        groups = track.select("vehicle_id", "line", "arrival_ms").distinct()
    else:
        raise ValueError(f"dedup must be 'line' or 'member', not {dedup!r}")
    return with_member(groups.withColumn("score", score_of(F.col("line"))))


def merge_members(members: DataFrame, dedup: str = "line") -> DataFrame:
    """One set out of several: the union's members, deduplicated like ``recent_set``."""
    if dedup == "member":
        merged = members.select("vehicle_id", "score", "line", "arrival_ms").distinct()
    else:
        merged = members.groupBy("vehicle_id", "score", "line").agg(F.min("arrival_ms").alias("arrival_ms"))
    return with_member(merged)


def with_member(rows: DataFrame) -> DataFrame:
    member = text.stamped(F.col("line"), F.col("arrival_ms")).alias("member")
    return rows.select("vehicle_id", "score", member, "line", "arrival_ms")


def recent_track(recent: DataFrame, ids: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Kept points of vehicles by (score, member); a frame of ids (pos, vehicle_id) keeps its order."""
    if isinstance(ids, DataFrame):
        return match(recent, ids, ["vehicle_id"]).orderBy("pos", "score", "member")
    found = recent if ids is None else recent.filter(F.col("vehicle_id").isin(list(ids)))
    return found.orderBy("vehicle_id", "score", "member")


def rank_range(
    recent: DataFrame, first: int, last: int, hot_rows: int | None = None, count_in: DataFrame | None = None
) -> DataFrame:
    """Members with rank in [first, last]; negative ranks count from the end (0, -1 = all)."""
    ranked = group_rank(
        recent, ["vehicle_id"], _ascending(), "rank", size="_size", hot_rows=hot_rows, count_in=count_in
    )
    low = F.lit(first) if first >= 0 else F.col("_size") + first
    high = F.lit(last) if last >= 0 else F.col("_size") + last
    return ranked.filter((F.col("rank") >= low) & (F.col("rank") <= high)).drop("_size")


def latest_position(recent: DataFrame) -> DataFrame:
    """Newest point per vehicle: one partial aggregate."""
    rest = [c for c in recent.columns if c not in ("vehicle_id", "score", "member")]
    best = recent.groupBy("vehicle_id").agg(F.max(F.struct("score", "member", *rest)).alias("_w"))
    return best.select("vehicle_id", "_w.*")


def set_size(recent: DataFrame) -> DataFrame:
    return recent.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n"))


def set_keys(recent: DataFrame) -> DataFrame:
    return recent.select("vehicle_id").distinct().select(text.set_name(F.col("vehicle_id")).alias("set_name"))


def keep_last_n(
    recent: DataFrame, n: int = 1000, hot_rows: int | None = None, count_in: DataFrame | None = None
) -> DataFrame:
    """The ``n`` highest members of each vehicle."""
    return top_n(recent, ["vehicle_id"], _descending(), n, hot_rows, count_in)


def trimmed_rows(
    recent: DataFrame, n: int = 1000, hot_rows: int | None = None, count_in: DataFrame | None = None
) -> DataFrame:
    """What ``keep_last_n`` leaves out."""
    ranked = group_rank(recent, ["vehicle_id"], _descending(), "_rank", hot_rows=hot_rows, count_in=count_in)
    return ranked.filter(F.col("_rank") >= n).drop("_rank")


def key_slices(keys: DataFrame, n: int, key: str = "set_name") -> DataFrame:
    """Keys in byte order cut into ``n`` runs of ``total div n``; the last run takes the rest."""
    ranked, total = table_rank(keys.select(key).distinct(), [F.col(key)], "_rank")
    size = total // n
    number = F.least(text.whole_parts(F.col("_rank"), size), F.lit(n - 1)) if size else F.lit(n - 1)
    return ranked.select(key, number.cast("int").alias("slice"))
