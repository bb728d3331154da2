"""Duplicates of vehicle events and of messages: latest, first seen, by sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 3_600_000  # of arrival, in milliseconds: an hour of one sensor is ordered at a time


def _one_of_each(rows: DataFrame, keys: list, order: list, first: bool) -> DataFrame:
    """Of the rows of each key the first (or last) in ``order``.

    Most keys have one row. Keys are counted by a hash aggregation over themselves and the leading
    column of ``order``, which combines map-side; the few that repeat then mark their rows by a join
    (a broadcast, while they are few), and only rows of theirs that share the leading value are ranked.
    Rows whose key does not repeat neither move nor are sorted, unless the join has to shuffle.
    """
    lead = F.min(order[0]) if first else F.max(order[0])
    several = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), lead.alias("_lead")).where("_n > 1").drop("_n").withColumn("_twice", F.lit(True))
    marked = rows.join(several, keys, "left")
    alone = marked.where(F.col("_twice").isNull()).select(*rows.columns)
    again = marked.where(F.col("_twice") & F.col(order[0]).eqNullSafe(F.col("_lead")))
    rest = [F.col(c).asc() if first else F.col(c).desc() for c in (order[1:] or order)]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*rest))
    return alone.unionByName(again.withColumn("_rank", rank).where("_rank = 1").select(*rows.columns))


def latest(df: DataFrame, keys: list, version: list) -> DataFrame:
    """One row per key: the one with the largest version."""
    return _one_of_each(df, keys, version, first=False)


def first_seen(df: DataFrame, key: str, order: list, columns: list | None = None) -> DataFrame:
    """One row per key: the first in the order of arrival; with ``columns`` only these (and the key) are kept."""
    kept = df.columns if columns is None else [key, *[c for c in columns if c != key]]
    needed = list(dict.fromkeys([*kept, *order]))
    return _one_of_each(df.select(*needed), [key], order, first=True).select(*kept)


def not_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been stored yet."""
    return df.join(seen.select(key), key, "left_anti")


def vehicles_dedup(vehicles: DataFrame, *columns: str, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """The latest version of each event; with ``columns`` only these (and the keys) are kept.

    All versions of an event entered on one day, by which the table is stored. ``since`` and ``until``
    (times of entry) therefore keep whole days below the comparison of versions, down to the scan;
    the exact limits are for the caller to set above it.
    """
    keys, version = ["tunnel_id", "event_id"], ["inserted_at", "kafka_partition", "kafka_offset"]
    day = lambda t: F.date_trunc("day", t).cast("timestamp_ntz")
    if since is not None:
        vehicles = vehicles.where(F.col("ts_entry") >= day(since))
    if until is not None:
        vehicles = vehicles.where(F.col("ts_entry") < day(until) + F.make_dt_interval(F.lit(1)))
    kept = [*keys, *[c for c in columns if c not in keys]] if columns else vehicles.columns
    return latest(vehicles.select(*dict.fromkeys([*kept, *version])), keys, version).select(*kept)


def sequence_gaps(detections: DataFrame) -> DataFrame:
    """Per sensor and boot: messages, distinct ones, duplicates, and how many numbers are missing."""
    per = detections.groupBy("sensor_id", "boot_id").agg(
        F.count(F.lit(1)).alias("received"), F.countDistinct("seq").alias("accepted"), F.min("seq").alias("low"), F.max("seq").alias("high")
    )
    return per.select("sensor_id", "boot_id", "received", "accepted", (F.col("received") - F.col("accepted")).alias("duplicates"), (F.col("high") - F.col("low") + 1 - F.col("accepted")).alias("lost"))


def by_sequence(detections: DataFrame, window: int = 512, block: int = BLOCK) -> DataFrame:
    """Messages that count, by their sensor's sequence numbers (``sensor_id, boot_id, seq, arrival``).

    In order of arrival, a sensor's rows fall into runs of one boot. In a run a number counts once,
    and not if it lies ``window`` or more below the highest number before it.

    A scan in two levels: rows are ordered only within a sensor's blocks of ``block`` units of arrival;
    each block is summed up (boots at its ends, changes of boot, highest number since the last one),
    and what a block needs to know of the past comes from a scan of these few summaries. Any width
    gives the same rows, so a sensor's history never lies in one task.
    """
    order = ["arrival", "message_id"]
    part = ["sensor_id", "_block"]
    rows = detections.withColumn("_block", F.floor(F.col("arrival") / block))
    inside = W.partitionBy(*part).orderBy(*order)
    rows = rows.withColumn("_began", F.coalesce((F.col("boot_id") != F.lag("boot_id").over(inside)).cast("int"), F.lit(0)))
    rows = rows.withColumn("_run", F.sum("_began").over(inside))
    blocks = rows.groupBy(*part).agg(
        F.min_by("boot_id", F.struct(*order)).alias("_first"), F.max_by("boot_id", F.struct(*order)).alias("_last"),
        F.max("_run").alias("_changes"), F.max(F.struct("_run", "seq")).alias("_tail"),
    )
    blocks = carried_runs(blocks)
    run = W.partitionBy(*part, "_run").orderBy(*order)
    rows = rows.withColumn("_top", F.max("seq").over(run.rowsBetween(W.unboundedPreceding, -1))).join(blocks, part)
    goes_on = F.col("_run") == 0
    rows = rows.withColumns({"_top": F.greatest("_top", F.when(goes_on, F.col("_carried"))), "_run": F.col("_run") + F.col("_head")})
    rows = rows.withColumn("_again", F.row_number().over(W.partitionBy("sensor_id", "_run", "seq").orderBy(*order)))
    counts = (F.col("_again") == 1) & (F.col("_top").isNull() | (F.col("seq") > F.col("_top") - window))
    return rows.where(counts).select(*detections.columns)


def carried_runs(blocks: DataFrame) -> DataFrame:
    """``sensor_id, _block, _head, _carried`` of blocks: the number of the run that a block begins in, and
    the highest number of that run in all blocks before."""
    by_time = W.partitionBy("sensor_id").orderBy("_block")
    before = by_time.rowsBetween(W.unboundedPreceding, -1)
    began = F.coalesce((F.col("_first") != F.lag("_last").over(by_time)).cast("int"), F.lit(0))
    runs = blocks.withColumn("_new", began)
    runs = runs.withColumn("_head", F.coalesce(F.sum(F.col("_new") + F.col("_changes")).over(before), F.lit(0)) + F.col("_new"))
    # runs are numbered in order of time: the largest pair holds the last run before, and its highest number
    past = F.max(F.struct((F.col("_head") + F.col("_changes")).alias("run"), F.col("_tail.seq").alias("top"))).over(before)
    runs = runs.withColumn("_past", past)
    return runs.select("sensor_id", "_block", "_head", F.when(F.col("_past.run") == F.col("_head"), F.col("_past.top")).alias("_carried"))


def first_per_key(df: DataFrame, key: str, order: list, k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key; ranks stop at k inside the sort, before the shuffle ends."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
