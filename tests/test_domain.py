"""Validation, rollups, sources, lifecycle and streams of the domain."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from adit.operators import lifecycle, rollup
from adit.operators.validate import validated
from adit.sources import domain
from adit.streaming import pipeline

DET = {
    "schema": 2, "message_id": "TR-BOLU-start:b0:1", "sensor_id": "TR-BOLU-start", "device_id": "02:aa", "device_serial": "TSN-1", "tunnel_id": "TR-BOLU", "position": "start", "seq": 1, "ts": 1_700_000_000_000,
    "lane": 1, "occupancy_ms": 10, "direction": "start_to_end", "plate": "", "speed_kmh": 72.0, "length_m": 4, "confidence": 0.9, "classification": "OTOMOBIL",
}
HEALTH = {"schema": 2, "sensor_id": "TR-BOLU-end", "device_id": "a", "device_serial": "b", "tunnel_id": "TR-BOLU", "position": "end", "ts": 1, "status": "ok", "degraded": False, "window_s": 60, "uptime_s": 1.5, "detections": 1, "duplicates": 0, "missed": 0}
TO_HEALTH = "tunnels/TR-BOLU/sensors/end/health"


def env(body, topic="tunnels/TR-BOLU/sensors/start/detections", **over):
    data = body if isinstance(body, bytes) else json.dumps(body).encode()
    return json.dumps({"payload": base64.b64encode(data).decode(), "topicName": topic, "clientCertCn": "TR-BOLU", "ts": 1_700_000_000_001, "tbmqNode": "n1"} | over).encode()


def without(d, key):
    return {k: v for k, v in d.items() if k != key}


CASES = {
    "good": (env(DET), None, None),
    "health": (env(HEALTH, TO_HEALTH), None, None),
    "extra fields": (env(DET | {"new": [1, {"a": 2}]}), None, None),
    "null": (None, "bad_envelope", "record value is null"),
    "empty": (b"", "bad_envelope", "envelope is not valid UTF-8 JSON"),
    "not utf8": (b"\xff{}", "bad_envelope", "envelope is not valid UTF-8 JSON"),
    "array": (b"[1]", "bad_envelope", "envelope is not a JSON object"),
    "topic type": (env(DET, topicName=5), "bad_envelope", "topicName missing or not a string"),
    "payload type": (env(DET, payload=5), "bad_envelope", "payload missing or not a string"),
    "base64": (env(DET, payload="YQ"), "bad_envelope", "payload is not valid base64"),
    "ts float": (env(DET, ts=1.0), "bad_envelope", "ts missing or not an integer"),
    "ts bool": (env(DET, ts=True), "bad_envelope", "ts missing or not an integer"),
    "topic": (env(DET, "tunnels/TR-BOLU/sensors/side/detections"), "bad_topic", "topic is not"),
    "no cn": (env(DET, clientCertCn=None), "identity_mismatch", "clientCertCn missing"),
    "cn": (env(DET, clientCertCn="X"), "identity_mismatch", "clientCertCn 'X' != topic tunnel_id 'TR-BOLU'"),
    "payload json": (env(b"nope"), "bad_payload", "payload is not valid UTF-8 JSON"),
    "payload array": (env(b"[]"), "bad_payload", "payload is not a JSON object"),
    "no schema": (env(without(DET, "schema")), "bad_payload", "missing field 'schema'"),
    "schema 1": (env(DET | {"schema": 1}), "unsupported_schema", "schema 1 (supported: 2)"),
    "schema text": (env(DET | {"schema": "2"}), "unsupported_schema", "schema '2' (supported: 2)"),
    "schema null": (env(DET | {"schema": None}), "unsupported_schema", "schema None (supported: 2)"),
    "missing": (env(without(DET, "plate")), "bad_payload", "missing field 'plate'"),
    "big seq": (env(DET | {"seq": 10**30}), "bad_payload", "field 'seq' must be an integer"),
    "bool seq": (env(DET | {"seq": True}), "bad_payload", "field 'seq' must be an integer"),
    "speed": (env(DET | {"speed_kmh": "1"}), "bad_payload", "field 'speed_kmh' must be a number"),
    "class": (env(DET | {"classification": "bus"}), "bad_payload", "field 'classification' must be one of BILINMEYEN|"),
    "mismatch": (env(DET | {"position": "end"}), "payload_mismatch", "payload tunnel_id/position/sensor_id 'TR-BOLU'/'end'/'TR-BOLU-start' != topic"),
    "degraded": (env(HEALTH | {"degraded": 1}, TO_HEALTH), "bad_payload", "field 'degraded' must be a boolean"),
    "long": (b"x" + "é".encode() * 5000, "bad_envelope", "envelope is not valid UTF-8 JSON"),
}


def test_first_failing_check_decides(spark):
    raw = spark.createDataFrame([(k, bytearray(v) if v is not None else None) for k, (v, _, _) in CASES.items()], "name string, value binary")
    for r in validated(raw, now_ms=F.lit(5)).collect():
        _, reason, detail = CASES[r["name"]]
        assert r["reason"] == reason, r["name"]
        record = json.loads(r["record"])
        if reason is None:
            assert r["kind"] == ("health" if r["name"] == "health" else "detection")
            assert (record["received_ts"], record["processed_ts"], record["tbmq_node"]) == (1_700_000_000_001, 5, "n1")
        else:
            assert r["kind"] == "rejected" and detail in r["detail"]
            assert len(record["envelope"]) <= 4096 and record["reason"] == reason
    assert True


def test_rollups_merge_in_any_order(spark):
    rows = spark.range(3000).select(
        F.concat(F.lit("T"), (F.col("id") % 2).cast("string")).alias("tunnel_id"), F.lit("d").alias("direction"), F.lit("c").alias("classification"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("ts_entry"),
        (F.col("id") % 90).cast("double").alias("speed_kmh"), F.lit(4.0).alias("length_m"), F.col("id"),
    )
    whole = rollup.finalised(rollup.rollup(rows, "hour"), "hour")
    parts = [rollup.rollup(rows.where(F.col("id") % 3 == k), "hour") for k in (2, 0, 1)]
    merged = rollup.finalised(rollup.merge(parts[0].unionByName(parts[1]), ["hour", *rollup.KEYS]).unionByName(parts[2]), "hour")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(whole) == key(merged)
    # relative error of the sketch
    for r in rows.where("tunnel_id = 'T0'").groupBy(F.date_trunc("hour", "ts_entry").cast("timestamp_ntz").alias("hour")).agg(F.sort_array(F.collect_list("speed_kmh")).alias("v")).collect():
        got = whole.where((F.col("tunnel_id") == "T0") & (F.col("hour") == F.lit(r["hour"]))).first()
        exact = r["v"][max(0, -(-85 * len(r["v"]) // 100) - 1)]
        assert abs(got["speed_p85_kmh"] - exact) <= 0.01 * exact + 1e-9


def test_topics_are_typed_with_defaults_and_bad_records_apart(spark):
    good = json.dumps({k: v for k, v in DET.items() if k != "lane"}).encode()
    old = json.dumps(DET | {"ts": 5}).encode()
    raw = spark.createDataFrame([(bytearray(good), 1, 10), (bytearray(b"{broken"), 1, 11), (bytearray(old), 1, 12)], "value binary, partition int, offset long")
    rows, bad = domain.read_topic(raw, "detections")
    (r,) = rows.collect()
    assert (r["lane"], r["vehicle_id"], r["offset"], r["speed_kmh"]) == (0, None, 10, 72.0)
    assert [x["offset"] for x in bad.collect()] == [11]


def test_compacted_topic(spark):
    records = spark.createDataFrame([("a", "1", 0, 1), ("a", "2", 0, 5), ("b", "3", 0, 2), ("b", None, 0, 3)], "key string, value string, partition int, offset long")
    assert [(r["key"], r["value"]) for r in domain.latest_of_topic(records).collect()] == [("a", "2")]


def test_times_of_day():
    assert [domain.minutes(x) for x in ("00:00", "07:30", "24:00")] == [0, 450, 1440]
    for bad in ("24:01", "7:30", "07:60", "aa:bb", ""):
        with pytest.raises(ValueError):
            domain.minutes(bad)


def test_dimensions_from_a_file(spark):
    text = "tunnels:\n- {tunnel_id: A, name: n, city: c, city_code: 1, length_m: 5, lanes_per_direction: 2, speed_limit_kmh: 70, rules: [{types: [KAMYON, OTOBUS], from: '22:00', to: '06:00'}]}\n"
    profiles, rules = domain.dimensions_from_yaml(spark, text)
    assert profiles.count() == 1 and [(r["vehicle_type"], r["from_minute"], r["to_minute"]) for r in rules.collect()] == [("KAMYON", 1320, 360), ("OTOBUS", 1320, 360)]


def test_stored_tables_age_and_are_pruned(spark, tmp_path):
    rows = spark.createDataFrame([("TR-BOLU", f"2024-01-{d:02d} 10:00:00") for d in (1, 5, 9)] + [("T9", "2024-01-09 11:00:00")], "tunnel_id string, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    path, cold = str(tmp_path / "hot"), str(tmp_path / "cold")
    domain.stored(rows, path, "ts", ("tunnel_id", "ts"))
    assert [d for d, _ in lifecycle.partitions(spark, path)] == ["2024-01-01", "2024-01-05", "2024-01-09"]
    assert lifecycle.age(spark, path, cold, "2024-01-10", 3, 8) == (["2024-01-05"], ["2024-01-01"])
    lifecycle.exchange(spark, lifecycle.pruned(spark.read.parquet(path), domain.profiles(spark)), path)
    assert [r["tunnel_id"] for r in spark.read.parquet(path).collect()] == ["TR-BOLU"]


def test_what_changed_is_applied(spark):
    state = spark.createDataFrame([("a", lifecycle.checksum("1"), 1), ("a", lifecycle.checksum("2"), 2)], "name string, checksum string, applied_at long")
    assert lifecycle.to_apply(state, {"a": "1", "b": "x"}) == ["a", "b"]
    assert lifecycle.to_apply(state, {"a": "2"}) == []


def test_streams_split_records_and_count_events_once(spark, tmp_path):
    raw = spark.createDataFrame([(bytearray(v) if v is not None else None, 0, i) for i, (v, _, _) in enumerate(CASES.values())], "value binary, partition int, offset long")
    raw.write.parquet(str(tmp_path / "in"))
    pipeline.split_to_tables(pipeline.envelopes(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    counts = {k: spark.read.parquet(str(tmp_path / "out" / k)).count() for k in ("detection", "health", "rejected")}
    assert counts == {"detection": 2, "health": 1, "rejected": len(CASES) - 3}
    v = spark.range(200).select((F.col("id") % 120).cast("string").alias("event_id"), F.lit("T").alias("tunnel_id"), F.lit("d").alias("direction"), F.lit("c").alias("classification"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 120).alias("at"), F.lit(50.0).alias("speed_kmh"), F.lit(4.0).alias("length_m"))
    v.withColumn("ts_entry", F.col("at").cast("timestamp_ntz")).write.parquet(str(tmp_path / "v"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "v")).schema).parquet(str(tmp_path / "v"))
    pipeline.rollup_to_table(stream, str(tmp_path / "r"), str(tmp_path / "cp2")).awaitTermination(120)
    states = spark.read.parquet(str(tmp_path / "r")).drop("batch")
    assert rollup.finalised(states, "minute").agg(F.sum("vehicles")).first()[0] == 120


def test_metric_lines(spark):
    rows = spark.createDataFrame([("up", {"job": 'a"b', "pod": "1"}, 1.5), ("n", {}, 2.0)], "name string, labels map<string,string>, value double")
    assert [r["line"] for r in pipeline.metrics_text(rows).collect()] == ['up{job="a\\"b",pod="1"} 1.5', "n 2.0"]
