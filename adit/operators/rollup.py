"""Mergeable rollups of vehicle events: partial states that are stored, merged and finalised.

A state is a row of plain columns (count, sums, minimum, maximum) and a DDSketch, a map from
logarithmic bucket to count. Merging states is the same aggregation again, so rolling up twice,
compacting, or combining hours from minutes gives the same result in any order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adit.functions.scalar import bucket

KEYS = ("tunnel_id", "direction", "classification")
ALPHA = {"minute": 0.02, "hour": 0.01}
QUANTILES = (0.5, 0.85, 0.95)


def gamma(alpha: float) -> float:
    return (1 + alpha) / (1 - alpha)


def sketch_bucket(value: Column, alpha: float) -> Column:
    """Bucket of a value: ceil(log_gamma(v)); null for what is not positive (the zero bucket)."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(gamma(alpha))).cast("int"))


def sketch_value(b: Column, alpha: float) -> Column:
    g = gamma(alpha)
    return F.when(b.isNull(), F.lit(0.0)).otherwise(2 * F.pow(F.lit(g), b) / (g + 1))


def sketch_rows(df: DataFrame, keys: list, value: Column, alpha: float) -> DataFrame:
    """A sketch as a relation: the keys, ``b`` (null: zero bucket) and ``n``."""
    return df.groupBy(*keys, sketch_bucket(value, alpha).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, keys: list) -> DataFrame:
    return sketches.groupBy(*keys, "b").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, keys: list, quantiles=QUANTILES, alpha: float = 0.01) -> DataFrame:
    """The value of the smallest bucket whose cumulative count reaches the rank, for each quantile."""
    part = W.partitionBy(*keys)
    order = part.orderBy(F.col("b").asc_nulls_first())
    ranked = sketches.withColumns({"_upto": F.sum("n").over(order), "_all": F.sum("n").over(part)})
    picks = []
    for q in quantiles:
        met = F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("_all")))
        picks.append(F.min(F.when(met, sketch_value(F.col("b"), alpha))).alias(f"p{round(q * 100)}"))
    return ranked.groupBy(*keys).agg(*picks)


def rollup(vehicles: DataFrame, unit: str, time: str = "ts_entry") -> DataFrame:
    """States by bucket of time and ``KEYS``, in two aggregations that both combine map-side."""
    alpha, keys = ALPHA[unit], [unit, *KEYS]
    rows = vehicles.withColumn(unit, bucket(unit, time))
    parts = rows.groupBy(*keys, sketch_bucket(F.col("speed_kmh"), alpha).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("speed_kmh").alias("ss"), F.count("speed_kmh").alias("sc"), F.min("speed_kmh").alias("lo"),
        F.max("speed_kmh").alias("hi"), F.sum("length_m").alias("ls"), F.count("length_m").alias("lc"),
    )
    return _states(parts, keys)


def _states(parts: DataFrame, keys: list) -> DataFrame:
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("vehicles"),
        F.struct(F.sum("ss").alias("sum"), F.sum("sc").alias("count")).alias("speed_avg"),
        F.min("lo").alias("speed_min"),
        F.max("hi").alias("speed_max"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("b", F.lit(-(1 << 31)).cast("int")).alias("b"), "n")))).alias("speed_sketch"),
        F.struct(F.sum("ls").alias("sum"), F.sum("lc").alias("count")).alias("length_avg"),
    )


def merge(states: DataFrame, keys: list) -> DataFrame:
    """States merged to coarser (or the same) keys; also what compaction of stored states does."""
    exploded = states.select("*", F.posexplode(F.map_entries("speed_sketch")).alias("_i", "_e"))
    first = F.col("_i") == 0
    parts = exploded.groupBy(*keys, F.col("_e.key").alias("b")).agg(
        F.sum("_e.value").alias("n"), F.sum(F.when(first, F.col("speed_avg.sum"))).alias("ss"), F.sum(F.when(first, F.col("speed_avg.count"))).alias("sc"),
        F.min("speed_min").alias("lo"), F.max("speed_max").alias("hi"), F.sum(F.when(first, F.col("length_avg.sum"))).alias("ls"), F.sum(F.when(first, F.col("length_avg.count"))).alias("lc"),
    )
    return _states(parts, keys)


def average(state: str) -> Column:
    """Finalise an average state; null over nothing."""
    return F.when(F.col(f"{state}.count") > 0, F.col(f"{state}.sum") / F.col(f"{state}.count"))


def merged_average(state: str) -> Column:
    """Aggregate average states to one average."""
    n = F.sum(f"{state}.count")
    return F.when(n > 0, F.sum(f"{state}.sum") / n)


def finalised(states: DataFrame, unit: str, whole: bool = False) -> DataFrame:
    """Statistics by bucket and ``KEYS``: counts, averages, extrema and quantiles of the sketch.

    ``whole``: a key has one state, so that there is nothing to merge.
    """
    alpha, keys = ALPHA[unit], [unit, *KEYS]
    at = F.array(*[F.greatest(F.lit(1).cast("bigint"), F.ceil(F.lit(q) * F.col("vehicles"))) for q in QUANTILES])
    # one walk over the buckets in ascending order (the zero bucket has the smallest key) finds all quantiles
    begun = F.struct(F.lit(0).cast("bigint").alias("upto"), F.array(*[F.lit(None).cast("int")] * len(QUANTILES)).alias("found"))

    def step(a: Column, e: Column) -> Column:
        upto = a["upto"] + e["value"]
        found = F.transform(a["found"], lambda b, i: F.when(b.isNull() & (upto >= F.get("_at", i)), e["key"]).otherwise(b))
        return F.struct(upto.alias("upto"), found.alias("found"))

    rows = (states if whole else merge(states, keys)).withColumn("_at", at)
    rows = rows.withColumn("_found", F.aggregate(F.map_entries("speed_sketch"), begun, step, lambda a: a["found"]))
    value = lambda b: F.when(b == -(1 << 31), F.lit(0.0)).otherwise(sketch_value(b, alpha))
    return rows.select(
        *keys, "vehicles", average("speed_avg").alias("speed_avg_kmh"), F.col("speed_min").alias("speed_min_kmh"), F.col("speed_max").alias("speed_max_kmh"),
        *[value(F.get("_found", F.lit(k))).alias(f"speed_p{round(q * 100)}_kmh") for k, q in enumerate(QUANTILES)], average("length_avg").alias("length_avg_m"),
    )
