"""Derived columns of one row. All of them are projections, so they add no shuffle and also fit a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import off_hours, planar_distance, velocity
from ledgerlens.schema import TIME

# The features a model is trained on unless others are chosen.
DEFAULT_FEATURES = ["amount", "distance_from_home", "hour_of_day"]


def with_calendar(df: DataFrame, column: str = TIME) -> DataFrame:
    """`hour_of_day` 0-23, `day_of_week` 1 = Sunday to 7 = Saturday, `month` 1-12."""
    return df.withColumns(
        {
            "hour_of_day": F.hour(column),
            "day_of_week": F.dayofweek(column),
            "month": F.month(column),
        }
    )


def with_distance(df: DataFrame) -> DataFrame:
    """`distance_from_home`; a table without home columns is measured from (0, 0)."""
    has_home = {"home_lat", "home_long"} <= set(df.columns)
    home = (F.col("home_lat"), F.col("home_long")) if has_home else (F.lit(0.0), F.lit(0.0))
    here = (F.col("location_lat"), F.col("location_long"))
    return df.withColumn("distance_from_home", planar_distance(*here, *home))


def with_velocity(df: DataFrame) -> DataFrame:
    """`txn_velocity`, the reciprocal of the hours since the last transaction."""
    return df.withColumn("txn_velocity", velocity(F.col("time_since_last")))


def with_off_hours(df: DataFrame) -> DataFrame:
    """`off_hours` from `hour_of_day`."""
    return df.withColumn("off_hours", off_hours(F.col("hour_of_day")))


def build_features(df: DataFrame) -> DataFrame:
    """All derived columns, in dependency order."""
    for step in (with_calendar, with_distance, with_velocity, with_off_hours):
        df = df.transform(step)
    return df
