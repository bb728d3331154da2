"""Streams: raw envelopes to validated records, records to tables, vehicles to rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adit.operators import rollup
from adit.operators.lineage import checkpointed
from adit.operators.validate import validated
from adit.sources import domain


#: What a Kafka source gives for each record.
KAFKA_RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"


def envelopes(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """Raw records from files, as a Kafka source gives them: ``value`` and where they came from."""
    return spark.readStream.schema("value binary, partition int, offset long").option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def kafka_envelopes(spark: SparkSession, servers: str, topic: str, per_trigger: int = 500_000) -> DataFrame:
    """The same from Kafka, where its connector is installed."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger).load()
    )


def split_to_tables(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Validate once, write three tables. The batch number names what is written, so a repeated
    batch after a failure replaces its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        checked = checkpointed(validated(batch))
        for kind in ("detection", "health", "rejected"):
            rows = checked.where(F.col("kind") == kind).select("key", "record", "reason")
            rows.write.mode("overwrite").parquet(f"{path}/{kind}/batch={number}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_topic(raw: DataFrame, topic: str, path: str, checkpoint: str) -> StreamingQuery:
    """Append a topic's typed rows to its table, by day, and records that are none of its schema to ``<path>_broken``.

    Files of a batch lie under its number, so a batch that runs again replaces its own.
    """
    time = {"vehicles": "ts_entry", "rejected": "processed_ts"}.get(topic, "ts")

    def write(batch: DataFrame, number: int) -> None:
        rows, broken = domain.read_topic(checkpointed(batch), topic)
        day = F.to_date(F.timestamp_millis(F.col(time)))
        rows.withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")
        broken.write.mode("overwrite").parquet(f"{path}_broken/batch={number}")

    return raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def fan_out(vehicles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """One stream of vehicle events, each event once, to three tables in one batch: minute states, hour
    states, and the ids that were seen."""

    def write(batch: DataFrame, number: int) -> None:
        rows = checkpointed(batch)
        rollup.rollup(rows, "minute").write.mode("overwrite").parquet(f"{path}/minute/batch={number}")
        rollup.rollup(rows, "hour").write.mode("overwrite").parquet(f"{path}/hour/batch={number}")
        rows.select("event_id", "tunnel_id", "ts_entry").write.mode("overwrite").parquet(f"{path}/ids/batch={number}")

    return first_seen(vehicles).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(vehicles: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each event once, within the watermark's delay (``at``: event time)."""
    return vehicles.withWatermark("at", delay).dropDuplicatesWithinWatermark(["event_id"])


def rollup_to_table(vehicles: DataFrame, path: str, checkpoint: str, unit: str = "minute") -> StreamingQuery:
    """Append the states of each batch's new events; readers merge them (``rollup.finalised``)."""

    def write(batch: DataFrame, number: int) -> None:
        rollup.rollup(batch, unit).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return first_seen(vehicles).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(vehicles: DataFrame, every: str = "1 minute", delay: str = "10 minutes") -> DataFrame:
    """Tumbling event-time counts by tunnel and class."""
    return vehicles.withWatermark("at", delay).groupBy(F.window("at", every).alias("w"), "tunnel_id", "classification").agg(F.count(F.lit(1)).alias("vehicles")).select(F.col("w.start").alias("start"), "tunnel_id", "classification", "vehicles")


def changed_geometry(current: DataFrame, published: DataFrame) -> DataFrame:
    """Tunnel lengths that differ from the published ones at 0.1 m."""
    now = current.withColumn("length_m", F.round("length_m", 1))
    return now.join(published.select("tunnel_id", F.round("length_m", 1).alias("_was")), "tunnel_id", "left").where(~F.col("length_m").eqNullSafe(F.col("_was"))).drop("_was")


def metrics_text(values: DataFrame) -> DataFrame:
    """Samples (name, labels, value) as lines of the text exposition format."""
    pairs = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit('="'), F.regexp_replace(F.regexp_replace(e["value"], r"\\", r"\\\\"), '"', r'\\"'), F.lit('"')))
    labels = F.when(F.size("labels") > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))).otherwise("")
    return values.select(F.concat("name", labels, F.lit(" "), F.col("value").cast("string")).alias("line"))

