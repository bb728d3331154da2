"""Test data: synthetic tunnel traffic as a relation; every draw is a hash of (seed, vehicle, purpose).

The frame grows with ``spark.range``; nothing is iterated on the driver, and any row can be made
again on its own, so lost executors cost nothing but time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adit.functions.scalar import minute_of_day, plate_body
from adit.sources.domain import CLASSES, DIRECTIONS, POSITIONS, UNKNOWN

# All types but the unknown one alike often, each 1.5 m longer than the one before.
TYPES = [c for c in CLASSES if c != UNKNOWN]
LENGTHS = {kind: 3.0 + 1.5 * k for k, kind in enumerate(TYPES)}
VIOLATION, SPEEDERS, DUPLICATES, BURST = 0.02, 0.01, 0.005, 1.5
BURST_MINUTES = (17 * 60, 20 * 60)


def draw(seed: int, *of: Column | str) -> Column:
    """Uniform in (0, 1), a function of seed and arguments."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in of])
    return (F.pmod(h, F.lit(1 << 52)) + 0.5) / float(1 << 52)


def normal(seed: int, *of: Column | str) -> Column:
    u, v = draw(seed, *of, F.lit("u")), draw(seed, *of, F.lit("v"))
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)


def vehicles(spark: SparkSession, tunnels: DataFrame, per_tunnel: int, rate_s: float = 0.2, seed: int = 7, t0_ms: int = 1_705_000_000_000) -> DataFrame:
    """``per_tunnel`` vehicles of each tunnel, with exponential gaps (shorter in the evening)."""
    v = spark.range(per_tunnel).withColumnRenamed("id", "n").crossJoin(F.broadcast(tunnels.select("tunnel_id", "length_m", "speed_limit_kmh", "lanes_per_direction")))
    gap = -F.log(draw(seed, "tunnel_id", "n", F.lit("gap"))) / rate_s
    v = v.withColumn("offset_s", F.sum(gap).over(W.partitionBy("tunnel_id").orderBy("n").rowsBetween(W.unboundedPreceding, 0)))
    # the burst: time runs faster for those who arrive in it
    at = F.timestamp_millis((F.lit(t0_ms) + F.col("offset_s") * 1000).cast("long"))
    minute = minute_of_day(F.from_utc_timestamp(at, "Europe/Istanbul"))
    burst = (minute >= BURST_MINUTES[0]) & (minute < BURST_MINUTES[1])
    kind = F.get(F.array(*map(F.lit, TYPES)), F.floor(draw(seed, "tunnel_id", "n", F.lit("type")) * len(TYPES)).cast("int"))
    fast = draw(seed, "tunnel_id", "n", F.lit("fast")) < SPEEDERS
    speed = F.when(fast, F.col("speed_limit_kmh") * (1.15 + 0.3 * draw(seed, "tunnel_id", "n", F.lit("over")))).otherwise(
        F.least(F.greatest(F.col("speed_limit_kmh") * (0.9 + 0.06 * normal(seed, "tunnel_id", "n", F.lit("speed"))), F.lit(30.0)), F.col("speed_limit_kmh"))
    )
    lengths = F.create_map(*[F.lit(x) for kv in LENGTHS.items() for x in kv])
    return v.select(
        "tunnel_id", "n", F.concat("tunnel_id", F.lit("-v"), F.col("n").cast("string")).alias("vehicle_id"), kind.alias("true_class"), burst.alias("burst"),
        (F.lit(t0_ms) + F.col("offset_s") * F.when(burst, 1 / BURST).otherwise(1.0) * 1000).alias("entry_ms"), speed.alias("speed_kmh"), (F.col("length_m") / 2).alias("half_m"),
        F.when(draw(seed, "tunnel_id", "n", F.lit("dir")) < 0.5, DIRECTIONS[0]).otherwise(DIRECTIONS[1]).alias("direction"),
        (F.floor(draw(seed, "tunnel_id", "n", F.lit("lane")) * F.col("lanes_per_direction")) + 1).cast("int").alias("lane"),
        F.concat(F.lpad((F.pmod(F.xxhash64("tunnel_id", "n"), F.lit(81)) + 1).cast("string"), 2, "0"), F.lit(" "), plate_body(F.pmod(F.xxhash64("n", "tunnel_id"), F.lit(8_777_600)))).alias("plate"),
    ).withColumn("true_length_m", F.element_at(lengths, F.col("true_class")))


def detections(traffic: DataFrame, seed: int = 7, miss: float = 0.01, unread: float = 0.1, unknown: float = 0.02, noise: float = 0.03, degraded: float = 0.0) -> DataFrame:
    """What three sensors report of each vehicle: misses, noise, classes, and now and then a repeat.

    ``degraded``: the share of sensors that are five times as noisy and miss five times as much.
    """
    d = traffic.withColumn("position", F.explode(F.array(*map(F.lit, POSITIONS))))
    index = F.when(F.col("position") == "middle", 1).when((F.col("position") == "start") == (F.col("direction") == DIRECTIONS[0]), 0).otherwise(2)
    of = ("tunnel_id", "n", "position")
    weak = draw(seed, "tunnel_id", "position", F.lit("weak")) < degraded
    times = F.when(weak, 5.0).otherwise(1.0)
    d = d.withColumns({"_i": index, "_x": times}).where(draw(seed, *of, F.lit("miss")) >= F.least(F.col("_x") * miss, F.lit(0.5)))
    speed = F.col("speed_kmh") * (1 + normal(seed, *of, F.lit("s")) * F.least(F.col("_x") * noise, F.lit(0.5)))
    length = F.greatest(F.col("true_length_m") + normal(seed, *of, F.lit("l")) * 0.3 * F.col("_x"), F.lit(0.5))
    ts = (F.col("entry_ms") + F.col("_i") * F.col("half_m") / (F.col("speed_kmh") / 3.6) * 1000 + normal(seed, *of, F.lit("t")) * 5).cast("long")
    order = list(CLASSES)
    wrong = F.element_at(F.array(*map(F.lit, order)), (F.pmod(F.xxhash64(*of), F.lit(len(order) - 1)) + 1).cast("int"))
    seen = F.when(draw(seed, *of, F.lit("c")) < unknown, UNKNOWN).when(draw(seed, *of, F.lit("w")) < 0.02 * F.col("_x"), wrong).otherwise(F.col("true_class"))
    d = d.select(
        "tunnel_id", F.concat("tunnel_id", F.lit("-"), "position").alias("sensor_id"), "position", "direction", "lane", F.when(draw(seed, *of, F.lit("p")) < unread, "").otherwise(F.col("plate")).alias("plate"),
        F.round(F.greatest(speed, F.lit(5.0)), 1).alias("speed_kmh"), F.round(length, 2).alias("length_m"), F.round(F.lit(0.75) + 0.24 * draw(seed, *of, F.lit("q")), 3).alias("confidence"),
        seen.alias("classification"), ts.alias("ts"), (F.col("true_length_m") / (F.col("speed_kmh") / 3.6) * 1000).cast("long").alias("occupancy_ms"), "vehicle_id", "true_class", F.lit("b0").alias("boot_id"),
    )
    by_sensor = W.partitionBy("sensor_id").orderBy("ts", "vehicle_id")
    d = d.withColumn("seq", F.row_number().over(by_sensor).cast("long")).withColumn("arrival", F.col("ts"))
    d = d.withColumn("message_id", F.concat_ws(":", "sensor_id", "boot_id", F.col("seq").cast("string")))
    again = d.where(draw(seed, "message_id", F.lit("again")) < DUPLICATES).withColumn("arrival", F.col("arrival") + 5 + F.floor(draw(seed, "message_id", F.lit("delay")) * 495))
    return d.unionByName(again)


def health(found: DataFrame, window_s: int = 60) -> DataFrame:
    """Self-reports by window: how much a sensor saw, and what it says about itself."""
    w = (F.floor(F.col("ts") / (1000 * window_s)) * window_s).alias("window")
    per = found.groupBy("tunnel_id", "sensor_id", "position", w).agg(F.countDistinct("message_id").alias("detections"), (F.count(F.lit(1)) - F.countDistinct("message_id")).alias("duplicates"), (F.max("seq") - F.min("seq") + 1 - F.countDistinct("seq")).alias("missed"))
    return per.withColumn("status", F.when(F.col("detections") == 0, "silent").when(F.col("missed") > F.col("detections") / 5, "degraded").otherwise("ok"))
