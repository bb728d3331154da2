"""Topics to day-partitioned tables, and one stream to three tables: streams against batches."""

import json

import pytest
from pyspark.sql import functions as F

from adit.operators import rollup
from adit.sources import binding, domain
from adit.streaming import online, pipeline, sensors

T = 1_720_000_000_000
DAY = 86_400_000
RECORDS = {
    "detections": {"schema": 2, "message_id": "T1-end:b:7", "sensor_id": "T1-end", "tunnel_id": "T1", "position": "end", "seq": 7, "ts": T, "lane": 1, "speed_kmh": 61.5},
    "health": {"schema": 2, "sensor_id": "T1-end", "tunnel_id": "T1", "ts": T, "status": "degraded", "degraded": True, "window_s": 60.0, "detections": 12, "missed": 3},
    "vehicles": {"schema": 2, "event_id": "T1-end:b:7", "tunnel_id": "T1", "ts_entry": T, "ts_exit": T + 5, "sensors": 2, "missing": ["middle"], "detections": ["a", "b"]},
    "traffic": {"schema": 2, "tunnel_id": "T1", "ts": T, "window_s": 60.0, "vehicles": 5, "counts": {"start_to_end": {"OTOMOBIL": 4, "KAMYON": 1}, "end_to_start": {}}},
    "rejected": {"reason": "bad_topic", "detail": "d", "topic": None, "client_cert_cn": None, "received_ts": None, "processed_ts": T, "envelope": "x"},
}
EXPECTED = {
    "detections": {"plate": "", "vehicle_id": None, "speed_kmh": 61.5, "occupancy_ms": 0, "seq": 7},
    "health": {"status": "degraded", "degraded": True, "duplicates": 0, "missed": 3, "position": ""},
    "vehicles": {"missing": ["middle"], "detections": ["a", "b"], "true_class": None, "plate": ""},
    "traffic": {"counts": {"start_to_end": {"OTOMOBIL": 4, "KAMYON": 1}, "end_to_start": {}}, "avg_speed_kmh": None, "length_m": None},
    "rejected": {"topic": None, "received_ts": None, "envelope": "x"},
}


@pytest.mark.parametrize("topic", sorted(RECORDS))
def test_a_topic_becomes_a_table_by_day(spark, tmp_path, topic):
    time = {"vehicles": "ts_entry", "rejected": "processed_ts"}.get(topic, "ts")
    records = [RECORDS[topic] | {time: T + k * DAY, "unknown": 1} for k in range(3)] + [RECORDS[topic] | {time: 5}]  # the last: an implausible time
    values = [json.dumps(r) for r in records] + ["{broken", "[]"]
    rows = spark.createDataFrame([(v.encode(), k % 2, k) for k, v in enumerate(values)], "value binary, partition int, offset long")
    for part in (rows.where("offset < 2"), rows.where("offset >= 2")):
        part.write.mode("append").parquet(str(tmp_path / "in"))
        pipeline.load_topic(pipeline.envelopes(spark, str(tmp_path / "in")), topic, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination(120)
    stored = spark.read.parquet(str(tmp_path / "table"))
    assert {str(r["day"]) for r in stored.select("day").collect()} == {"2024-07-03", "2024-07-04", "2024-07-05"}
    first = stored.where(F.col(time) == T).collect()[0].asDict(recursive=True)
    assert {k: first[k] for k in EXPECTED[topic]} == EXPECTED[topic]
    columns = [c for c in stored.columns if c not in ("batch", "day")]
    as_text = lambda df: sorted(r["j"] for r in df.select(F.to_json(F.struct(*columns)).alias("j")).collect())
    batch, broken = domain.read_topic(rows, topic)
    assert as_text(stored) == as_text(batch) and stored.count() == 3
    assert spark.read.parquet(str(tmp_path / "table_broken")).count() == broken.count() >= 1


def recorded(spark, values, topic):
    """Records as Kafka gives them, their timestamps 20 ms after one another."""
    rows = spark.createDataFrame([(v.encode(), k) for k, v in enumerate(values)], "value binary, offset long")
    return rows.select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit(topic).alias("topic"), F.lit(0).alias("partition"), "offset",
        F.timestamp_millis(F.lit(T) + F.col("offset") * 20).alias("timestamp"), F.lit(0).alias("timestampType"),
    )


@pytest.mark.parametrize("topic", ["rejected", "vehicles"])
def test_records_of_a_broker_become_a_table(spark, tmp_path, topic):
    recorded(spark, [json.dumps(RECORDS[topic] | {"topic": "own"}), "{broken"], topic).write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema(pipeline.KAFKA_RECORD).parquet(str(tmp_path / "in"))
    pipeline.load_topic(raw, topic, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination(120)
    stored = spark.read.parquet(str(tmp_path / "table")).collect()
    assert len(stored) == 1 and stored[0]["offset"] == 0
    assert stored[0]["topic"] == ("own" if topic == "rejected" else topic)  # a field of the topic goes before the broker's
    assert topic != "rejected" or stored[0]["record_topic"] == topic
    assert spark.read.parquet(str(tmp_path / "table_broken")).count() == 1


def test_records_of_a_broker_are_split_and_fused(spark, tmp_path):
    """A topic of detections as a broker gives it: the events are those of the typed table."""
    recorded(spark, ["{broken"], "in").write.parquet(str(tmp_path / "raw"))
    pipeline.split_to_tables(spark.readStream.schema(pipeline.KAFKA_RECORD).parquet(str(tmp_path / "raw")), str(tmp_path / "split"), str(tmp_path / "cp0")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "split" / "rejected")).count() == 1

    def detection(position, k, seq, boot="b"):
        at = T + 20_000 * k + {"start": 0, "middle": 30_000, "end": 60_000}[position]
        return {
            "schema": 2, "message_id": f"T1-{position}:{boot}:{seq}", "sensor_id": f"T1-{position}", "tunnel_id": "T1", "position": position, "seq": seq, "ts": at, "lane": 1,
            "direction": domain.DIRECTIONS[0], "plate": f"34 AB {k:03d}", "speed_kmh": 90.0, "length_m": 4.0 + k % 3, "confidence": 0.9, "classification": "OTOMOBIL",
        }

    sent = sorted((detection(p, k, k + 1) for k in range(8) for p in domain.POSITIONS), key=lambda d: d["ts"])
    sent += [detection("start", 900, 1, "b2")]  # the sensor began anew, much later: time passes for all before
    values = [json.dumps(d) for d in sent]
    values[3:3] = [values[2], "{broken"]  # a repeat and a broken record
    recorded(spark, values, "detections").coalesce(1).write.parquet(str(tmp_path / "in"))
    known = spark.createDataFrame([("T1", 750.0)], "tunnel_id string, half_m double")
    raw = spark.readStream.schema(pipeline.KAFKA_RECORD).parquet(str(tmp_path / "in"))
    spark.conf.set(*sensors.STORE)
    online.fuse_topic(raw, str(tmp_path / "out"), str(tmp_path / "cp"), known=known, use_noise=False, idle_s=None, behind_s=None, lateness_s=1e9).awaitTermination(200)
    spark.conf.unset(sensors.STORE[0])
    found = {tuple(sorted(r["detections"])) for r in spark.read.parquet(str(tmp_path / "out" / "events")).collect()}
    assert found == {tuple(sorted(f"T1-{p}:b:{k + 1}" for p in domain.POSITIONS)) for k in range(8)}
    pending = online.States(spark, str(tmp_path / "out" / "state")).before(10**9)["pending"].collect()
    assert [(r["message_id"], r["boot_id"]) for r in pending] == [("T1-start:b2:1", "b2")]
    assert pending[0]["arrival"] == T + (len(values) - 1) * 20


def test_one_stream_feeds_minutes_hours_and_ids(spark, tmp_path):
    vehicles = binding.vehicles(spark, "/root/testdata/sf0.001").withColumn("at", F.col("ts_entry").cast("timestamp"))
    for k in range(2):
        vehicles.where(f"kafka_partition % 2 = {k}").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(vehicles.schema).parquet(str(tmp_path / "in"))
        pipeline.fan_out(stream.withColumn("at", F.col("at")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    ids = spark.read.parquet(str(tmp_path / "out/ids"))
    assert ids.count() == ids.select("event_id").distinct().count() > 0
    whole = ids.count()
    for unit in ("minute", "hour"):
        states = spark.read.parquet(str(tmp_path / "out" / unit))
        merged = rollup.finalised(states, unit)
        assert merged.agg(F.sum("vehicles")).first()[0] == whole
        assert merged.select(unit, *rollup.KEYS).distinct().count() == merged.count()


def test_published_geometry_and_dimensions_are_brought_up_to_date(spark):
    from adit.operators.lifecycle import synced

    now = spark.createDataFrame([("A", 100.04), ("B", 200.0), ("C", 5.0)], "tunnel_id string, length_m double")
    published = spark.createDataFrame([("A", 100.0), ("B", 200.2)], "tunnel_id string, length_m double")
    assert sorted(r["tunnel_id"] for r in pipeline.changed_geometry(now, published).collect()) == ["B", "C"]
    stored = spark.createDataFrame([("A", "old", 3), ("B", "old", 1), ("D", "gone", 9)], "tunnel_id string, name string, updated_at int")
    given = spark.createDataFrame([("A", "new", 2), ("B", "new", 2), ("C", "new", 2)], "tunnel_id string, name string, updated_at int")
    assert sorted(tuple(r) for r in synced(stored, given, ["tunnel_id"]).collect()) == [("A", "old", 3), ("B", "new", 2), ("C", "new", 2)]
