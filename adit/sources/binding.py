"""Domain tables derived from the generic ``events`` table, in Spark and, for comparison, in SQL.

Every event becomes a vehicle event, a detection and a health report of one of six tunnels (five
are configured, T000005 is not). All columns are arithmetic on ``event_id``, ``user_id`` and
``value``, so both engines derive the same rows. Each seventh event comes a second time with a
later insert and a higher speed, as a replay would bring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.sources.domain import CLASSES, DIRECTIONS, POSITIONS, PROFILES, RULES, STATUSES

TUNNELS = tuple(p[0] for p in PROFILES) + ("T000005",)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(values, index):
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _ms(ts, ms):
    """A timestamp without zone, some milliseconds later."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms / F.lit(1000)).cast("decimal(18,6)"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle events as inserted, replays included."""
    e, i = events(spark, sf_dir), F.col("event_id")
    base = e.select(
        F.concat(F.lit("e"), i.cast("string")).alias("event_id"),
        _pick(TUNNELS, F.col("user_id") % 6).alias("tunnel_id"),
        F.col("ts").alias("ts_entry"),
        _ms(F.col("ts"), (i % 300 + 60) * 1000).alias("ts_exit"),
        _pick(DIRECTIONS, i % 2).alias("direction"),
        (i % 3 + 1).cast("int").alias("lane"),
        F.concat(F.lit("34 AB "), F.lpad((i % 9973).cast("string"), 4, "0")).alias("plate"),
        (20 + F.floor(F.col("value") * 10) % 1000 / F.lit(10.0)).alias("speed_kmh"),
        (F.lit(3.5) + i % 12).cast("double").alias("length_m"),
        _pick(CLASSES, i % 10).alias("classification"),
        (F.lit(0.5) + i % 50 / F.lit(100.0)).alias("confidence"),
        _pick((1.0, 0.667, 0.333), i % 3).alias("agreement"),
        (i % 3 + 1).cast("int").alias("sensors"),
        (i % 4).cast("int").alias("kafka_partition"),
        i.alias("kafka_offset"),
        _ms(F.col("ts"), F.lit(400000)).alias("inserted_at"),
        (i % 7 == 0).alias("again"),
    )
    replay = base.where("again").withColumns({"speed_kmh": F.col("speed_kmh") + 1, "inserted_at": _ms(F.col("inserted_at"), F.lit(1000)), "kafka_offset": F.col("kafka_offset") + 1000000000})
    return base.unionByName(replay).drop("again")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = events(spark, sf_dir), F.col("event_id")
    tunnel, position = _pick(TUNNELS, F.col("user_id") % 6), _pick(POSITIONS, i % 3)
    received = _ms(F.col("ts"), i % 200)
    processed = _ms(received, i % 57)
    return e.select(
        F.concat(tunnel, F.lit("-"), position, F.lit(":b"), (F.col("user_id") % 2).cast("string"), F.lit(":"), i.cast("string")).alias("message_id"),
        F.concat(tunnel, F.lit("-"), position).alias("sensor_id"),
        tunnel.alias("tunnel_id"),
        position.alias("position"),
        (F.col("user_id") % 2).cast("string").alias("boot_id"),
        i.alias("seq"),
        "ts",
        _pick(DIRECTIONS, i % 2).alias("direction"),
        (i % 3 + 1).cast("int").alias("lane"),
        (20 + F.floor(F.col("value") * 10) % 1000 / F.lit(10.0)).alias("speed_kmh"),
        _pick(CLASSES, i % 10).alias("classification"),
        (F.lit(0.5) + i % 50 / F.lit(100.0)).alias("confidence"),
        received.alias("received_ts"),
        processed.alias("processed_ts"),
        _ms(processed, i % 3001).alias("inserted_at"),
    )


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    reasons = ("bad_envelope", "bad_topic", "identity_mismatch", "bad_payload", "payload_mismatch", "unsupported_schema")
    return events(spark, sf_dir).where("event_type = 'error'").select(
        F.col("ts").alias("processed_ts"),
        _pick(reasons, i % 6).alias("reason"),
        F.when(i % 6 > 1, _pick(TUNNELS, F.col("user_id") % 6)).alias("tunnel_id"),
        F.concat(F.lit("detail of event "), i.cast("string"), F.lit(" "), F.repeat(F.lit("x"), 150)).alias("detail"),
        F.when(i % 4 > 0, F.concat(F.lit("cn"), (F.col("user_id") % 9).cast("string"))).alias("client_cert_cn"),
        i.alias("record"),
    )


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = events(spark, sf_dir), F.col("event_id")
    tunnel, position = _pick(TUNNELS, F.col("user_id") % 6), _pick(POSITIONS, i % 3)
    return e.select(
        "ts",
        tunnel.alias("tunnel_id"),
        F.concat(tunnel, F.lit("-"), position).alias("sensor_id"),
        position.alias("position"),
        F.concat(F.lit("02:"), position, F.lit(":"), (F.col("user_id") % 4).cast("string")).alias("device_id"),
        F.concat(F.lit("TSN-"), F.lpad((i % 1000).cast("string"), 10, "0")).alias("device_serial"),
        _pick(STATUSES, F.floor(i / 3) % 3).alias("status"),
        (i % 40).alias("detections"),
        (i % 3).alias("duplicates"),
        (i % 5).alias("missed"),
        (i % 100000).cast("double").alias("uptime_s"),
        i.alias("report"),
    )


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic windows with counts by direction and class, as maps."""
    e, i = events(spark, sf_dir), F.col("event_id")
    entry = F.map_from_arrays(F.array(_pick(CLASSES, i % 10), _pick(CLASSES, (i + 1) % 10)), F.array(i % 4 + 1, i % 3))
    empty = F.create_map().cast("map<string,bigint>")
    return e.select(
        "ts",
        _pick(TUNNELS, F.col("user_id") % 6).alias("tunnel_id"),
        F.when(i % 2 == 0, entry).otherwise(empty).alias("start_to_end"),
        F.when(i % 5 == 0, entry).otherwise(empty).alias("end_to_start"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long frame of counters: cumulative events per minute, reset at noon, for each type and pod."""
    e = events(spark, sf_dir).select(
        F.col("event_type").alias("job"), (F.col("user_id") % 3).cast("string").alias("pod"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")
    )
    per = e.groupBy("job", "pod", "ts").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window as W

    half = (F.hour("ts") >= 12).cast("int")
    w = W.partitionBy("job", "pod", F.to_date("ts"), half).orderBy("ts").rowsBetween(W.unboundedPreceding, 0)
    return per.select("job", "pod", "ts", F.sum("n").over(w).cast("double").alias("value"))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)


_T = f"({_list(TUNNELS)})[user_id % 6 + 1]"
_P = f"({_list(POSITIONS)})[event_id % 3 + 1]"
_D = f"({_list(DIRECTIONS)})[event_id % 2 + 1]"
_C = f"({_list(CLASSES)})[event_id % 10 + 1]"
_SPEED = "20::DOUBLE + (floor(value * 10)::BIGINT % 1000) / 10.0::DOUBLE"
#: The same tables for DuckDB, as common table expressions.
CTES = {
    "profiles": f"SELECT * FROM (VALUES {_values(PROFILES)}) t(tunnel_id, name, city, city_code, length_m, lanes_per_direction, speed_limit_kmh)",
    "rules": f"SELECT * FROM (VALUES {_values(RULES)}) t(tunnel_id, vehicle_type, from_minute, to_minute)",
    "v0": f"""SELECT 'e' || event_id AS event_id, event_id AS i, {_T} AS tunnel_id, ts AS ts_entry, ts + to_seconds(event_id % 300 + 60) AS ts_exit,
        {_D} AS direction, (event_id % 3 + 1)::INT AS lane, '34 AB ' || lpad((event_id % 9973)::VARCHAR, 4, '0') AS plate, {_SPEED} AS speed_kmh,
        (3.5 + event_id % 12)::DOUBLE AS length_m, {_C} AS classification, 0.5::DOUBLE + (event_id % 50) / 100.0::DOUBLE AS confidence,
        ([1.0, 0.667, 0.333]::DOUBLE[])[event_id % 3 + 1] AS agreement, (event_id % 3 + 1)::INT AS sensors, (event_id % 4)::INT AS kafka_partition,
        event_id AS kafka_offset, ts + INTERVAL 400 SECOND AS inserted_at FROM events""",
    "vehicles": """SELECT * EXCLUDE (i) FROM v0 UNION ALL SELECT * EXCLUDE (i) REPLACE (speed_kmh + 1 AS speed_kmh, inserted_at + INTERVAL 1 SECOND AS inserted_at,
        kafka_offset + 1000000000 AS kafka_offset) FROM v0 WHERE i % 7 = 0""",
    "dedup": "SELECT * FROM vehicles QUALIFY row_number() OVER (PARTITION BY tunnel_id, event_id ORDER BY inserted_at DESC, kafka_partition DESC, kafka_offset DESC) = 1",
    "firsts": "SELECT * FROM vehicles QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) = 1",
    "detections": f"""SELECT {_T} || '-' || {_P} || ':b' || (user_id % 2) || ':' || event_id AS message_id, {_T} || '-' || {_P} AS sensor_id, {_T} AS tunnel_id,
        {_P} AS position, (user_id % 2)::VARCHAR AS boot_id, event_id AS seq, ts, {_D} AS direction, (event_id % 3 + 1)::INT AS lane, {_SPEED} AS speed_kmh,
        {_C} AS classification, 0.5::DOUBLE + (event_id % 50) / 100.0::DOUBLE AS confidence, ts + to_milliseconds(event_id % 200) AS received_ts,
        ts + to_milliseconds(event_id % 200 + event_id % 57) AS processed_ts, ts + to_milliseconds(event_id % 200 + event_id % 57 + event_id % 3001) AS inserted_at
        FROM events""",
    "rejected": f"""SELECT ts AS processed_ts, (['bad_envelope', 'bad_topic', 'identity_mismatch', 'bad_payload', 'payload_mismatch', 'unsupported_schema'])[event_id % 6 + 1] AS reason,
        CASE WHEN event_id % 6 > 1 THEN {_T} END AS tunnel_id, 'detail of event ' || event_id || ' ' || repeat('x', 150) AS detail,
        CASE WHEN event_id % 4 > 0 THEN 'cn' || (user_id % 9) END AS client_cert_cn, event_id AS record FROM events WHERE event_type = 'error'""",
    "health": f"""SELECT ts, {_T} AS tunnel_id, {_T} || '-' || {_P} AS sensor_id, {_P} AS position, '02:' || {_P} || ':' || (user_id % 4) AS device_id,
        'TSN-' || lpad((event_id % 1000)::VARCHAR, 10, '0') AS device_serial, (['ok', 'degraded', 'silent'])[(event_id // 3) % 3 + 1] AS status,
        event_id % 40 AS detections, event_id % 3 AS duplicates, event_id % 5 AS missed, (event_id % 100000)::DOUBLE AS uptime_s, event_id AS report FROM events""",
    "traffic": f"""SELECT ts, {_T} AS tunnel_id, CASE WHEN event_id % 2 = 0 THEN event_id % 4 + 1 + event_id % 3 ELSE 0 END AS n_start,
        CASE WHEN event_id % 5 = 0 THEN event_id % 4 + 1 + event_id % 3 ELSE 0 END AS n_end,
        {_C} AS c1, event_id % 4 + 1 AS k1, event_id % 2 = 0 AS has_start FROM events""",
    "m0": "SELECT event_type AS job, (user_id % 3)::VARCHAR AS pod, date_trunc('hour', ts) AS ts, count(*) AS n FROM events GROUP BY ALL",
    "metrics": """SELECT job, pod, ts, (sum(n) OVER (PARTITION BY job, pod, ts::DATE, hour(ts) >= 12 ORDER BY ts ROWS UNBOUNDED PRECEDING))::DOUBLE AS value FROM m0""",
}


def sql(query: str) -> str:
    """A query with the common table expressions it needs (in their order) in front."""
    needed = set()

    def need(text: str) -> None:
        import re

        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                need(CTES[name])

    need(query)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    body = query.strip()
    if not head:
        return body
    return f"WITH {head}" + (f",\n{body[5:]}" if body.upper().startswith("WITH ") else f"\n{body}")
