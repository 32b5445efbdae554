"""Fraud-signal expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first and last hour of the ordinary day, both inside it.
DAY_STARTS, DAY_ENDS = 6, 22


def off_hours(hour: Column) -> Column:
    """1 outside the ordinary day, 0 inside it and for an unknown hour."""
    outside = ~hour.between(DAY_STARTS, DAY_ENDS)
    return F.coalesce(outside, F.lit(False)).cast("int")


def planar_distance(lat: Column, long: Column, home_lat: Column, home_long: Column) -> Column:
    """Straight-line distance in degrees (not great-circle)."""
    dy, dx = lat - home_lat, long - home_long
    return F.sqrt(dy * dy + dx * dx)


def velocity(gap: Column) -> Column:
    """Reciprocal of a gap; unknown for a missing or zero gap. Negative gaps pass through."""
    return F.lit(1.0) / F.nullif(gap, F.lit(0.0))
