"""Positions from heading and speed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velotrail.functions.motion import BASE_LATITUDE, BASE_LONGITUDE, step
from velotrail.plans.ranks import group_rank


def dead_reckon(track: DataFrame, seconds: float = 10.0) -> DataFrame:
    """Expected position ``seconds`` ahead; needs lon, lat, angle_deg, velocity_kmh."""
    east, north = step(F.col("angle_deg"), F.col("velocity_kmh"), seconds)
    return track.withColumns({"next_lon": F.col("lon") + east, "next_lat": F.col("lat") + north})


def integrate_track(
    track: DataFrame,
    lon0: float = BASE_LONGITUDE,
    lat0: float = BASE_LATITUDE,
    seconds: float = 10.0,
    hot_rows: int | None = None,
) -> DataFrame:
    """Path from a start position: each record is placed after the steps of the records before it."""
    east, north = step(F.col("angle_deg"), F.col("velocity_kmh"), seconds)
    moved = group_rank(
        track, ["vehicle_id"], [F.col("event_ms"), F.col("line")], "_rank",
        sums={"_east": east, "_north": north}, hot_rows=hot_rows,
    )
    return moved.withColumns({
        "path_lon": F.lit(float(lon0)) + F.col("_east"), "path_lat": F.lit(float(lat0)) + F.col("_north"),
    }).drop("_rank", "_east", "_north")
