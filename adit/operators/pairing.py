"""Joins on travel time: which detections at two or three sensors can be the same vehicle.

Range conditions on time become equi-joins on time buckets as wide as the range, each row of one
side going to the buckets its range touches; the range itself is checked after. No side is ever
compared as a whole with the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plates_agree(a: Column, b: Column) -> Column:
    """An unread plate agrees with any."""
    return (a == "") | (b == "") | (a == b)


def range_join(left: DataFrame, right: DataFrame, keys: list, low: Column, high: Column, at: Column, width: int) -> DataFrame:
    """Pairs with equal ``keys`` and ``low`` (of left) <= ``at`` (of right) <= ``high`` (of left).

    ``width``: the bucket, about as wide as ranges are; any width gives the same pairs.
    """
    spread = left.withColumn("_bucket", F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))).withColumns({"_low": low, "_high": high})
    placed = right.withColumn("_at", at).withColumn("_bucket", F.floor(F.col("_at") / width))
    both = spread.join(placed, [*keys, "_bucket"]).where((F.col("_at") >= F.col("_low")) & (F.col("_at") <= F.col("_high")))
    return both.drop("_bucket", "_low", "_high", "_at")


def pair_candidates(lasts: DataFrame, middles: DataFrame, half_m: float, tolerance_ms: int = 250, ratio: float = 0.03) -> DataFrame:
    """Middle detections within the travel time of each last one: keys tunnel_id, direction, lane.

    Both sides have ``ms`` and ``message_id`` (suffixed ``_l`` and ``_m``), the last ``speed_l`` in km/h.
    """
    dt = half_m / (F.col("speed_l") / 3.6) * 1000
    tolerance = tolerance_ms + F.abs(dt) * ratio
    return range_join(lasts, middles, ["tunnel_id", "direction", "lane"], F.col("ms_l") - dt - tolerance, F.col("ms_l") - dt + tolerance, F.col("ms_m"), 10_000)


def triplets(pairs: DataFrame, firsts: DataFrame, tolerance_ms: int = 150) -> DataFrame:
    """First detections where the middle lies half-way in time: first near 2 * middle - last."""
    expected = 2 * F.col("ms_m") - F.col("ms_l")
    return range_join(pairs, firsts, ["tunnel_id", "direction", "lane"], expected - tolerance_ms, expected + tolerance_ms, F.col("ms_f"), 10_000)
