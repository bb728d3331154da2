"""Alerts: vehicle events joined to the profile and the access rules of their tunnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adit.functions.scalar import hhmm, in_window, local_time, minute_of_day

TOLERANCE = 1.05
MIN_SENSORS = 2
MIN_CONFIDENCE = 0.7
DIMENSION_ROWS = 200_000


def dimension(df: DataFrame, most: int = DIMENSION_ROWS) -> DataFrame:
    """A dimension table, marked for broadcast while its size allows that; else joined by shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def speeding(vehicles: DataFrame, profiles: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Corroborated vehicles faster than the limit of their tunnel by more than the tolerance."""
    v = vehicles.where(F.col("sensors") >= MIN_SENSORS)
    p = dimension(profiles.select("tunnel_id", F.col("name").alias("tunnel_name"), "city", "speed_limit_kmh"))
    over = F.col("speed_kmh") - F.col("speed_limit_kmh")
    return v.join(p, "tunnel_id").where(F.col("speed_kmh") > F.col("speed_limit_kmh") * tolerance).select(
        "ts_entry", local_time("ts_entry").alias("local_time"), F.to_date(local_time("ts_entry")).alias("local_day"), "tunnel_id", "tunnel_name", "city", "plate",
        F.col("classification").alias("vehicle_type"), "speed_kmh", "speed_limit_kmh", F.round(over, 1).alias("over_by_kmh"),
        F.round(100 * (F.col("speed_kmh") / F.col("speed_limit_kmh") - 1), 1).alias("over_by_pct"), "direction", "lane", "sensors", "confidence", "event_id",
    )


def restricted(vehicles: DataFrame, profiles: DataFrame, rules: DataFrame) -> DataFrame:
    """Corroborated, confident vehicles of a type banned in their tunnel at that local minute; a row for each rule."""
    v = vehicles.where((F.col("sensors") >= MIN_SENSORS) & (F.col("confidence") >= MIN_CONFIDENCE))
    p = dimension(profiles.select("tunnel_id", F.col("name").alias("tunnel_name"), "city"))
    r = dimension(rules.withColumnRenamed("vehicle_type", "classification"))
    here = local_time("ts_entry")
    joined = v.join(p, "tunnel_id").join(r, ["tunnel_id", "classification"])
    return joined.where(in_window(minute_of_day(here), F.col("from_minute"), F.col("to_minute"))).select(
        "ts_entry", here.alias("local_time"), F.to_date(here).alias("local_day"), "tunnel_id", "tunnel_name", "city", "plate", F.col("classification").alias("vehicle_type"),
        F.round("speed_kmh", 1).alias("speed_kmh"), "direction", "lane", "sensors", "confidence",
        F.concat(hhmm(F.col("from_minute")), F.lit("-"), hhmm(F.col("to_minute"))).alias("banned_window"), "event_id",
    )
