"""Displacement of a vehicle from its heading and speed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Degrees per metre, the value of pi, km/h per m/s, start position.
DEGREES_PER_METRE = 8.9832e-6
PI = 3.1415926
KMH_PER_MPS = 3.6
BASE_LONGITUDE = 116.0
BASE_LATITUDE = 40.0


def step(angle: Column, velocity: Column, seconds: float = 10.0) -> tuple[Column, Column]:
    """(delta longitude, delta latitude) in degrees after ``seconds``."""
    heading = angle.cast("double") * F.lit(PI / 180.0)
    metres = velocity.cast("double") / F.lit(KMH_PER_MPS) * F.lit(float(seconds))
    degrees = metres * F.lit(DEGREES_PER_METRE)
    return degrees * F.cos(heading), degrees * F.sin(heading)
