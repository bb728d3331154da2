"""Counters that only rise, as rates: each snapshot against the last one of its worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def increases(snapshots: DataFrame, keys: list[str], at: str, value: str, last: DataFrame | None = None) -> DataFrame:
    """``snapshots`` with ``rise`` (since the worker's last snapshot) and ``seconds`` (between them).

    A value below the last one means a restart: all of it is new. The first snapshot of a worker has
    no rise. ``last`` (``keys, at, value``) holds the last snapshots of workers from an earlier run, as
    ``last_snapshots`` gives them, so that runs over parts give what one run over the whole gives.
    """
    columns = [*keys, at, value]
    rows = snapshots.select(*columns, F.lit(True).alias("_new"))
    if last is not None:
        rows = rows.unionByName(last.select(*columns, F.lit(False).alias("_new")))
    by_time = W.partitionBy(*keys).orderBy(at)
    before, since = F.lag(value).over(by_time), F.lag(at).over(by_time)
    rise = F.when(F.col(value) >= F.col("_before"), F.col(value) - F.col("_before")).otherwise(F.when(F.col("_before").isNotNull(), F.col(value)))
    rows = rows.withColumns({"_before": before, "_since": since}).where("_new")
    return rows.select(*columns, rise.alias("rise"), F.timestamp_diff("SECOND", F.col("_since"), F.col(at)).alias("seconds"))


def last_snapshots(snapshots: DataFrame, keys: list[str], at: str, value: str, last: DataFrame | None = None) -> DataFrame:
    """The newest snapshot of each worker: what the next run has to know."""
    columns = [*keys, at, value]
    rows = snapshots.select(*columns) if last is None else snapshots.select(*columns).unionByName(last.select(*columns))
    return rows.groupBy(*keys).agg(F.max(at).alias(at), F.max_by(value, at).alias(value)).select(*columns)


def total_rate(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by, total, rate``: rises added up, and per second, of workers that had a snapshot before."""
    each: Column = F.col("rise") / F.col("seconds")
    return rows.where("seconds > 0").groupBy(*by).agg(F.sum("rise").alias("total"), F.sum(each).alias("rate"))
