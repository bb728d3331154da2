"""Quantiles from sketches of bounded size that merge.

A KLL sketch holds some hundred values whatever it was made of; sketches of parts merge to a sketch
of the whole, so each task sends one. Ranks are off by at most ``rank_error``, with probability 0.99.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """How far a rank may be off, as a share of all rows, by the sketch's published bound for one quantile."""
    return 2.296 / k**0.9021


def sketches(rows: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """``keys, sketch`` of a column; nulls do not count."""
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"))


def merged(parts: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    return parts.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def quantiles_of(parts: DataFrame, keys: list[str], quantiles: tuple[float, ...]) -> DataFrame:
    """``keys, n`` and ``p50`` and so on, of sketches."""
    some = F.kll_sketch_get_n_double("sketch") > 0
    picks = [F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(q))).alias(f"p{round(100 * q)}") for q in quantiles]
    return parts.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), *picks)
