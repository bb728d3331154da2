"""The dashboard queries Q01 to Q44 and the views V1 to V8.

Times that a dashboard would take from the clock are parameters: ``NOW`` stands for the moment of
looking, ranges end there. Results keep the names a panel shows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adit.functions.scalar import bucket, hhmm, local_time, map_total, millis_between, ratio
from adit.operators import alerts, rollup, states
from adit.operators.dedup import vehicles_dedup
from adit.operators.lineage import shared_folder
from adit.operators.versions import Conflict, Store
from adit.plans import Registry
from adit.sources import binding, domain

R = Registry()
NOW = "2024-01-20 12:00:00"
SINCE = "2024-01-05 00:00:00"
SHOWN = ("TR-AVRASYA", "TR-BOLU", "TR-ZIGANA", "T000005")
_IN = "tunnel_id IN ('TR-AVRASYA', 'TR-BOLU', 'TR-ZIGANA', 'T000005')"
_RANGE = f"BETWEEN TIMESTAMP '{SINCE}' AND TIMESTAMP '{NOW}'"


def moment(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


def in_range(col: str) -> Column:
    return F.col(col).between(moment(SINCE), moment(NOW))


def last(col: str, days: int = 0, minutes: int = 0) -> Column:
    """Within so long before NOW."""
    return (F.col(col) >= moment(NOW) - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(minutes))) & (F.col(col) <= moment(NOW))


def shown() -> Column:
    return F.col("tunnel_id").isin(*SHOWN)


def latency(d: DataFrame) -> DataFrame:
    return d.withColumns(
        {"mqtt_ms": millis_between("ts", "received_ts"), "process_ms": millis_between("received_ts", "processed_ts"), "ingest_ms": millis_between("received_ts", "inserted_at")}
    )


_ALERTED = ("ts_entry", "plate", "classification", "speed_kmh", "direction", "lane", "sensors", "confidence")


def stored_states(spark: SparkSession, sf_dir: str) -> Store:
    """The store of minute and hour states of a folder's vehicles, in the shared folder; taken in where
    it is not yet. It is known by the files (names, sizes, times) that it was made from."""
    files = sorted(f"{r['path']} {r['length']} {r['modificationTime']}" for r in spark.read.format("binaryFile").load(f"{sf_dir}/events.parquet").select("path", "length", "modificationTime").collect())
    name = hashlib.sha256("\n".join(files).encode()).hexdigest()
    store = Store(spark, f"{shared_folder(spark)}/states-{name[:32]}")
    try:
        states.take_in(store, binding.vehicles(spark, sf_dir), name)
    except Conflict:  # taken in by another at the same time
        pass
    return store


def minute_states(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    return states.read(stored_states(spark, sf_dir), "minute", since, until)


def hour_states(spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None) -> DataFrame:
    return states.read(stored_states(spark, sf_dir), "hour", since, until)


_MS = "date_sub('millisecond', ts, received_ts)"
_PS = "date_sub('millisecond', received_ts, processed_ts)"
_IS = "date_sub('millisecond', received_ts, inserted_at)"
_LATE = f"(SELECT *, {_MS} AS mqtt_ms, {_PS} AS process_ms, {_IS} AS ingest_ms FROM detections)"
_MIN = "(SELECT *, date_trunc('minute', ts_entry) AS minute FROM firsts)"
_HOUR = "(SELECT *, date_trunc('hour', ts_entry) AS hour FROM firsts)"


@R.add("Q01_freshness", f"SELECT CASE WHEN count(*) = 0 THEN NULL ELSE date_sub('second', max(inserted_at), TIMESTAMP '{NOW}') END AS seconds_behind FROM detections WHERE inserted_at BETWEEN TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND TIMESTAMP '{NOW}'")
def q01(spark, d):
    rows = binding.detections(spark, d).where(last("inserted_at", days=1))
    return rows.agg(F.when(F.count(F.lit(1)) > 0, F.timestamp_diff("SECOND", F.max("inserted_at"), moment(NOW))).alias("seconds_behind"))


@R.add("Q02_ingest_p95", f"SELECT quantile_cont(ingest_ms, 0.95) / 1000 AS p95_seconds FROM {_LATE} WHERE ts {_RANGE}")
def q02(spark, d):
    return latency(binding.detections(spark, d)).where(in_range("ts")).agg((F.percentile("ingest_ms", 0.95) / 1000).alias("p95_seconds"))


@R.add("Q03_stored", f"SELECT count(*) AS rows FROM detections WHERE ts {_RANGE}")
def q03(spark, d):
    return binding.detections(spark, d).where(in_range("ts")).agg(F.count(F.lit(1)).alias("rows"))


@R.add(
    "Q04_last_vehicles",
    f"SELECT ts_exit AS time, tunnel_id, direction, lane, classification, round(speed_kmh, 1) AS speed_kmh, round(length_m, 1) AS length_m, sensors, round(agreement, 2) AS agreement, event_id FROM vehicles WHERE ts_entry {_RANGE} ORDER BY ts_exit DESC, event_id, speed_kmh LIMIT 20",
)
def q04(spark, d):
    v = binding.vehicles(spark, d).where(in_range("ts_entry"))
    return v.select(F.col("ts_exit").alias("time"), "tunnel_id", "direction", "lane", "classification", F.round("speed_kmh", 1).alias("speed_kmh"), F.round("length_m", 1).alias("length_m"), "sensors", F.round("agreement", 2).alias("agreement"), "event_id").orderBy(F.desc("time"), "event_id", "speed_kmh").limit(20)


@R.add("Q05_last_rejections", f"SELECT processed_ts AS time, reason, tunnel_id, client_cert_cn, substring(detail, 1, 120) AS detail FROM rejected WHERE processed_ts {_RANGE} ORDER BY processed_ts DESC, record LIMIT 20")
def q05(spark, d):
    r = binding.rejected(spark, d).where(in_range("processed_ts")).orderBy(F.desc("processed_ts"), "record").limit(20)
    return r.select(F.col("processed_ts").alias("time"), "reason", "tunnel_id", "client_cert_cn", F.substring("detail", 1, 120).alias("detail"))


@R.add("Q06_latency_series", f"SELECT date_trunc('hour', ts) AS time, quantile_cont(mqtt_ms, 0.95) / 1000 AS mqtt_p95, quantile_cont(process_ms, 0.95) / 1000 AS processor_p95, quantile_cont(ingest_ms, 0.95) / 1000 AS clickhouse_p95 FROM {_LATE} WHERE ts {_RANGE} GROUP BY 1")
def q06(spark, d):
    p95 = lambda c: F.percentile(c, 0.95) / 1000
    rows = latency(binding.detections(spark, d)).where(in_range("ts"))
    return rows.groupBy(bucket("hour", "ts").alias("time")).agg(p95("mqtt_ms").alias("mqtt_p95"), p95("process_ms").alias("processor_p95"), p95("ingest_ms").alias("clickhouse_p95"))


@R.add("Q07_tunnel_picker", f"SELECT tunnel_id FROM profiles UNION SELECT DISTINCT tunnel_id FROM traffic WHERE ts {_RANGE}")
def q07(spark, d):
    seen = binding.traffic(spark, d).where(in_range("ts")).select("tunnel_id").distinct()
    return domain.profiles(spark).select("tunnel_id").union(seen).distinct()


@R.add("Q08_vehicles", f"SELECT count(*) AS vehicles FROM {_MIN} WHERE minute {_RANGE} AND {_IN}")
def q08(spark, d):
    return minute_states(spark, d, SINCE[:10], NOW[:10]).where(in_range("minute") & shown()).agg(F.sum("vehicles").alias("vehicles"))


@R.add("Q09_heavy_share", f"SELECT count(*) FILTER (classification IN {domain.HEAVY}) / greatest(count(*), 1) AS heavy FROM {_MIN} WHERE minute {_RANGE} AND {_IN}")
def q09(spark, d):
    heavy = F.coalesce(F.sum(F.when(F.col("classification").isin(*domain.HEAVY), F.col("vehicles"))), F.lit(0))
    return minute_states(spark, d, SINCE[:10], NOW[:10]).where(in_range("minute") & shown()).agg(ratio(heavy, F.sum("vehicles")).alias("heavy"))


@R.add("Q10_average_speed", f"SELECT round(avg(speed_kmh), 6) AS avg_speed FROM {_MIN} WHERE minute {_RANGE} AND {_IN}")
def q10(spark, d):
    return minute_states(spark, d, SINCE[:10], NOW[:10]).where(in_range("minute") & shown()).agg(F.round(rollup.merged_average("speed_avg"), 6).alias("avg_speed"))


@R.add("Q11_reporting", f"SELECT count(DISTINCT tunnel_id) AS tunnels FROM traffic WHERE ts BETWEEN TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND TIMESTAMP '{NOW}' AND {_IN}")
def q11(spark, d):
    return binding.traffic(spark, d).where(last("ts", days=1) & shown()).agg(F.countDistinct("tunnel_id").alias("tunnels"))


@R.add("Q12_by_type", f"SELECT date_trunc('hour', minute) AS time, classification, count(*) AS vehicles FROM {_MIN} WHERE minute {_RANGE} AND {_IN} GROUP BY ALL")
def q12(spark, d):
    rows = minute_states(spark, d, SINCE[:10], NOW[:10]).where(in_range("minute") & shown())
    return rows.groupBy(bucket("hour", "minute").alias("time"), "classification").agg(F.sum("vehicles").alias("vehicles"))


@R.add("Q13_speed_by_direction", f"SELECT date_trunc('hour', minute) AS time, direction, round(avg(speed_kmh), 6) AS speed FROM {_MIN} WHERE minute {_RANGE} AND {_IN} GROUP BY ALL")
def q13(spark, d):
    rows = minute_states(spark, d, SINCE[:10], NOW[:10]).where(in_range("minute") & shown())
    return rows.groupBy(bucket("hour", "minute").alias("time"), "direction").agg(F.round(rollup.merged_average("speed_avg"), 6).alias("speed"))


def _any(kinds) -> str:
    return "count(*) FILTER (classification IN (" + ", ".join(f"'{k}'" for k in kinds) + "))"


@R.add(
    "Q14_per_tunnel",
    f"SELECT tunnel_id, {_any(['OTOMOBIL'])} AS otomobil, {_any(domain.LIGHT)} AS hafif, {_any(domain.HEAVY)} AS agir, {_any(domain.OTHER)} AS diger, {_any([domain.UNKNOWN])} AS bilinmeyen, count(*) AS total, round(avg(speed_kmh), 1) AS avg_speed_kmh, round(max(speed_kmh), 1) AS max_speed_kmh FROM {_MIN} WHERE minute {_RANGE} AND {_IN} GROUP BY tunnel_id ORDER BY total DESC, tunnel_id LIMIT 50",
)
def q14(spark, d):
    of = lambda kinds: F.coalesce(F.sum(F.when(F.col("classification").isin(*kinds), F.col("vehicles"))), F.lit(0))
    rows = minute_states(spark, d, SINCE[:10], NOW[:10]).where(in_range("minute") & shown())
    return rows.groupBy("tunnel_id").agg(
        of(["OTOMOBIL"]).alias("otomobil"), of(domain.LIGHT).alias("hafif"), of(domain.HEAVY).alias("agir"), of(domain.OTHER).alias("diger"), of([domain.UNKNOWN]).alias("bilinmeyen"),
        F.sum("vehicles").alias("total"), F.round(rollup.merged_average("speed_avg"), 1).alias("avg_speed_kmh"), F.round(F.max("speed_max"), 1).alias("max_speed_kmh"),
    ).orderBy(F.desc("total"), "tunnel_id").limit(50)


@R.add("Q15_traffic_maps", f"SELECT date_trunc('hour', ts) AS time, sum(n_start)::BIGINT AS start_to_end, sum(n_end)::BIGINT AS end_to_start FROM traffic WHERE ts {_RANGE} AND {_IN} GROUP BY ALL")
def q15(spark, d):
    rows = binding.traffic(spark, d).where(in_range("ts") & shown())
    return rows.groupBy(bucket("hour", "ts").alias("time")).agg(F.sum(map_total(F.col("start_to_end"))).alias("start_to_end"), F.sum(map_total(F.col("end_to_start"))).alias("end_to_start"))


@R.add("Q16_speed_distribution", f"SELECT date_trunc('hour', ts_entry) AS time, round(quantile_cont(speed_kmh, 0.5), 6) AS p50, round(quantile_cont(speed_kmh, 0.85), 6) AS p85, round(quantile_cont(speed_kmh, 0.95), 6) AS p95 FROM dedup WHERE ts_entry {_RANGE} AND {_IN} GROUP BY ALL")
def q16(spark, d):
    rows = vehicles_dedup(binding.vehicles(spark, d), "ts_entry", "speed_kmh", **_shown_days()).where(in_range("ts_entry") & shown())
    return rows.groupBy(bucket("hour", "ts_entry").alias("time")).agg(*[F.round(F.percentile("speed_kmh", q), 6).alias(f"p{round(100 * q)}") for q in (0.5, 0.85, 0.95)])


@R.add("Q16_speed_distribution_raw", f"SELECT date_trunc('hour', ts_entry) AS time, round(quantile_cont(speed_kmh, 0.5), 6) AS p50, count(*) AS n FROM vehicles WHERE ts_entry {_RANGE} AND {_IN} GROUP BY ALL")
def q16_raw(spark, d):
    rows = binding.vehicles(spark, d).where(in_range("ts_entry") & shown())
    return rows.groupBy(bucket("hour", "ts_entry").alias("time")).agg(F.round(F.percentile("speed_kmh", 0.5), 6).alias("p50"), F.count(F.lit(1)).alias("n"))


@R.add("Q17_consensus_quality", f"SELECT date_trunc('hour', ts_entry) AS time, round(avg(agreement), 6) AS agreement, round(avg(confidence), 6) AS confidence, count(*) FILTER (sensors < 3) / count(*) AS incomplete_share FROM dedup WHERE ts_entry {_RANGE} AND {_IN} GROUP BY ALL")
def q17(spark, d):
    rows = vehicles_dedup(binding.vehicles(spark, d), "ts_entry", "agreement", "confidence", "sensors", **_shown_days()).where(in_range("ts_entry") & shown())
    return rows.groupBy(bucket("hour", "ts_entry").alias("time")).agg(F.round(F.avg("agreement"), 6).alias("agreement"), F.round(F.avg("confidence"), 6).alias("confidence"), (F.count_if(F.col("sensors") < 3) / F.count(F.lit(1))).alias("incomplete_share"))


@R.add("Q18_devices_by_status", f"SELECT status, count(*) AS sensors FROM (SELECT sensor_id, arg_max(status, (ts, report)) AS status FROM health WHERE ts {_RANGE} AND {_IN} GROUP BY sensor_id) GROUP BY status")
def q18(spark, d):
    rows = binding.health(spark, d).where(in_range("ts") & shown())
    latest = rows.groupBy("sensor_id").agg(F.max_by("status", F.struct("ts", "report")).alias("status"))
    return latest.groupBy("status").agg(F.count(F.lit(1)).alias("sensors"))


@R.add("Q19_miss_rate", f"SELECT date_trunc('hour', ts) AS time, position, sum(missed) / greatest(sum(missed + detections), 1) AS miss_rate FROM health WHERE ts {_RANGE} AND {_IN} GROUP BY ALL")
def q19(spark, d):
    rows = binding.health(spark, d).where(in_range("ts") & shown())
    return rows.groupBy(bucket("hour", "ts").alias("time"), "position").agg(ratio(F.sum("missed"), F.sum(F.col("missed") + F.col("detections"))).alias("miss_rate"))


@R.add("Q20_missed_duplicates", f"SELECT date_trunc('hour', ts) AS time, sum(missed)::BIGINT AS missed, sum(duplicates)::BIGINT AS duplicates FROM health WHERE ts {_RANGE} AND {_IN} GROUP BY ALL")
def q20(spark, d):
    rows = binding.health(spark, d).where(in_range("ts") & shown())
    return rows.groupBy(bucket("hour", "ts").alias("time")).agg(F.sum("missed").alias("missed"), F.sum("duplicates").alias("duplicates"))


def latest_health(rows: DataFrame) -> DataFrame:
    fields = ("device_id", "device_serial", "status", "missed", "duplicates", "detections", "uptime_s")
    best = rows.groupBy("tunnel_id", "sensor_id", "position").agg(F.max_by(F.struct(*fields), F.struct("ts", "report")).alias("_l"), F.max("ts").alias("last_report_ts"))
    return best.select("tunnel_id", "sensor_id", "position", *[F.col(f"_l.{f}").alias(f) for f in fields], "last_report_ts")


_LATEST = "(SELECT tunnel_id, sensor_id, position, arg_max(device_id, (ts, report)) AS device_id, arg_max(device_serial, (ts, report)) AS device_serial, arg_max(status, (ts, report)) AS status, arg_max(missed, (ts, report)) AS missed, arg_max(duplicates, (ts, report)) AS duplicates, arg_max(detections, (ts, report)) AS detections, arg_max(uptime_s, (ts, report)) AS uptime_s, max(ts) AS last_report_ts FROM health WHERE {} GROUP BY tunnel_id, sensor_id, position)"


@R.add("Q21_unhealthy", f"SELECT sensor_id, tunnel_id AS tunnel, device_id, device_serial AS serial, position, status, missed, duplicates, detections, last_report_ts AS last_report FROM {_LATEST.format(f'ts {_RANGE} AND {_IN}')} WHERE status <> 'ok' ORDER BY missed DESC, sensor_id LIMIT 100")
def q21(spark, d):
    rows = latest_health(binding.health(spark, d).where(in_range("ts") & shown())).where("status <> 'ok'")
    return rows.select("sensor_id", F.col("tunnel_id").alias("tunnel"), "device_id", F.col("device_serial").alias("serial"), "position", "status", "missed", "duplicates", "detections", F.col("last_report_ts").alias("last_report")).orderBy(F.desc("missed"), "sensor_id").limit(100)


@R.add("Q22_rejections", f"SELECT date_trunc('hour', processed_ts) AS time, reason, count(*) AS rejected FROM rejected WHERE processed_ts {_RANGE} GROUP BY ALL")
def q22(spark, d):
    return binding.rejected(spark, d).where(in_range("processed_ts")).groupBy(bucket("hour", "processed_ts").alias("time"), "reason").agg(F.count(F.lit(1)).alias("rejected"))


@R.add("Q23_pipeline_latency", f"SELECT date_trunc('hour', ts) AS time, quantile_cont(mqtt_ms, 0.95) / 1000 AS sensor_to_tbmq, quantile_cont(process_ms, 0.95) / 1000 AS tbmq_to_processor, quantile_cont(ingest_ms, 0.95) / 1000 AS tbmq_to_clickhouse FROM {_LATE} WHERE ts {_RANGE} AND {_IN} GROUP BY 1")
def q23(spark, d):
    p95 = lambda c: F.percentile(c, 0.95) / 1000
    rows = latency(binding.detections(spark, d)).where(in_range("ts") & shown())
    return rows.groupBy(bucket("hour", "ts").alias("time")).agg(p95("mqtt_ms").alias("sensor_to_tbmq"), p95("process_ms").alias("tbmq_to_processor"), p95("ingest_ms").alias("tbmq_to_clickhouse"))


@R.add("Q24_latency_percentiles", "SELECT date_trunc('hour', ts) AS time, " + ", ".join(f"quantile_cont({c}_ms, {p}) / 1000 AS {c}_p{round(p * 100)}" for c in ("mqtt", "process", "ingest") for p in (0.5, 0.95)) + f" FROM {_LATE} WHERE ts {_RANGE} GROUP BY 1")
def q24(spark, d):
    rows = latency(binding.detections(spark, d)).where(in_range("ts"))
    return rows.groupBy(bucket("hour", "ts").alias("time")).agg(*[(F.percentile(f"{c}_ms", p) / 1000).alias(f"{c}_p{round(p * 100)}") for c in ("mqtt", "process", "ingest") for p in (0.5, 0.95)])


_LOCAL = "ts_entry + INTERVAL 3 HOUR"
_SPEEDING = f"(SELECT ts_entry, {_LOCAL} AS local_time, ({_LOCAL})::DATE AS local_day, tunnel_id, name AS tunnel_name, city, plate, classification AS vehicle_type, speed_kmh, speed_limit_kmh::DOUBLE AS speed_limit_kmh, round(speed_kmh - speed_limit_kmh::DOUBLE, 1) AS over_by_kmh, round(100 * (speed_kmh / speed_limit_kmh::DOUBLE - 1), 1) AS over_by_pct, direction, lane, sensors, confidence, event_id FROM dedup JOIN profiles USING (tunnel_id) WHERE sensors >= 2 AND speed_kmh > speed_limit_kmh::DOUBLE * 1.05::DOUBLE)"
_M = f"(60 * hour({_LOCAL}) + minute({_LOCAL}))"
_HM = "lpad((from_minute // 60)::VARCHAR, 2, '0') || ':' || lpad((from_minute % 60)::VARCHAR, 2, '0') || '-' || lpad((to_minute // 60)::VARCHAR, 2, '0') || ':' || lpad((to_minute % 60)::VARCHAR, 2, '0')"
_RESTRICTED = f"(SELECT ts_entry, {_LOCAL} AS local_time, ({_LOCAL})::DATE AS local_day, tunnel_id, name AS tunnel_name, city, plate, classification AS vehicle_type, round(speed_kmh, 1) AS speed_kmh, direction, lane, sensors, confidence, {_HM} AS banned_window, event_id FROM dedup JOIN profiles USING (tunnel_id) JOIN rules USING (tunnel_id) WHERE classification = vehicle_type AND sensors >= 2 AND confidence >= 0.7 AND CASE WHEN from_minute < to_minute THEN {_M} >= from_minute AND {_M} < to_minute ELSE {_M} >= from_minute OR {_M} < to_minute END)"


def speeding(spark: SparkSession, d: str, **days: Column) -> DataFrame:
    return alerts.speeding(vehicles_dedup(binding.vehicles(spark, d), *_ALERTED, **days), domain.profiles(spark))


def restricted(spark: SparkSession, d: str, **days: Column) -> DataFrame:
    return alerts.restricted(vehicles_dedup(binding.vehicles(spark, d), *_ALERTED, **days), domain.profiles(spark), domain.rules(spark))


def _shown_days() -> dict[str, Column]:
    return {"since": moment(SINCE), "until": moment(NOW)}


def _today() -> dict[str, Column]:
    """Days, as stored, that the local day of NOW touches."""
    day = F.make_dt_interval(F.lit(1))
    return {"since": moment(NOW) - day, "until": moment(NOW) + day}


@R.add("Q25_speeding", f"SELECT count(*) AS speeding FROM {_SPEEDING} WHERE ts_entry {_RANGE} AND {_IN}")
def q25(spark, d):
    return speeding(spark, d, **_shown_days()).where(in_range("ts_entry") & shown()).agg(F.count(F.lit(1)).alias("speeding"))


@R.add("Q26_restricted", f"SELECT count(*) AS restricted FROM {_RESTRICTED} WHERE ts_entry {_RANGE} AND {_IN}")
def q26(spark, d):
    return restricted(spark, d, **_shown_days()).where(in_range("ts_entry") & shown()).agg(F.count(F.lit(1)).alias("restricted"))


@R.add("Q27_fastest", f"SELECT max(speed_kmh) AS top_speed FROM {_SPEEDING} WHERE ts_entry {_RANGE} AND {_IN}")
def q27(spark, d):
    return speeding(spark, d, **_shown_days()).where(in_range("ts_entry") & shown()).agg(F.max("speed_kmh").alias("top_speed"))


@R.add("Q28_tunnels_with_alert", f"SELECT count(DISTINCT tunnel_id) AS tunnels FROM (SELECT tunnel_id, ts_entry FROM {_SPEEDING} UNION ALL SELECT tunnel_id, ts_entry FROM {_RESTRICTED}) WHERE ts_entry {_RANGE} AND {_IN}")
def q28(spark, d):
    both = speeding(spark, d, **_shown_days()).select("tunnel_id", "ts_entry").unionByName(restricted(spark, d, **_shown_days()).select("tunnel_id", "ts_entry"))
    return both.where(in_range("ts_entry") & shown()).agg(F.countDistinct("tunnel_id").alias("tunnels"))


@R.add("Q29_speeding_list", f"SELECT local_time::VARCHAR AS time, tunnel_name AS tunnel, city, plate, vehicle_type AS type, round(speed_kmh, 1) AS speed_kmh, speed_limit_kmh AS limit_kmh, over_by_kmh, over_by_pct, event_id FROM {_SPEEDING} WHERE ts_entry {_RANGE} AND {_IN} ORDER BY local_time DESC, event_id LIMIT 1000")
def q29(spark, d):
    rows = speeding(spark, d, **_shown_days()).where(in_range("ts_entry") & shown()).orderBy(F.desc("local_time"), "event_id").limit(1000)
    return rows.select(F.col("local_time").cast("string").alias("time"), F.col("tunnel_name").alias("tunnel"), "city", "plate", F.col("vehicle_type").alias("type"), F.round("speed_kmh", 1).alias("speed_kmh"), F.col("speed_limit_kmh").alias("limit_kmh"), "over_by_kmh", "over_by_pct", "event_id")


@R.add("Q30_restricted_list", f"SELECT local_time::VARCHAR AS time, tunnel_name AS tunnel, city, plate, vehicle_type AS type, banned_window, speed_kmh, direction, lane, event_id FROM {_RESTRICTED} WHERE ts_entry {_RANGE} AND {_IN} ORDER BY local_time DESC, event_id, banned_window LIMIT 1000")
def q30(spark, d):
    rows = restricted(spark, d, **_shown_days()).where(in_range("ts_entry") & shown()).orderBy(F.desc("local_time"), "event_id", "banned_window").limit(1000)
    return rows.select(F.col("local_time").cast("string").alias("time"), F.col("tunnel_name").alias("tunnel"), "city", "plate", F.col("vehicle_type").alias("type"), "banned_window", "speed_kmh", "direction", "lane", "event_id")


@R.add("Q31_alerts_over_time", f"SELECT date_trunc('day', ts_entry) AS time, kind, count(*) AS alerts FROM (SELECT ts_entry, tunnel_id, 'speeding' AS kind FROM {_SPEEDING} UNION ALL SELECT ts_entry, tunnel_id, 'restricted' FROM {_RESTRICTED}) WHERE ts_entry {_RANGE} AND {_IN} GROUP BY ALL")
def q31(spark, d):
    kinds = {"speeding": speeding(spark, d, **_shown_days()), "restricted": restricted(spark, d, **_shown_days())}
    parts = [a.where(in_range("ts_entry") & shown()).groupBy(bucket("day", "ts_entry").alias("time")).agg(F.lit(k).alias("kind"), F.count(F.lit(1)).alias("alerts")) for k, a in kinds.items()]
    return parts[0].unionByName(parts[1])


@R.add("Q32_alerts_per_tunnel", f"SELECT tunnel_name AS tunnel, count(*) FILTER (kind = 's') AS speeding, count(*) FILTER (kind = 'r') AS restricted FROM (SELECT ts_entry, tunnel_id, tunnel_name, 's' AS kind FROM {_SPEEDING} UNION ALL SELECT ts_entry, tunnel_id, tunnel_name, 'r' FROM {_RESTRICTED}) WHERE ts_entry {_RANGE} AND {_IN} GROUP BY ALL")
def q32(spark, d):
    one = lambda a, s, r: a.where(in_range("ts_entry") & shown()).groupBy(F.col("tunnel_name").alias("tunnel")).agg(F.sum(F.lit(s)).alias("speeding"), F.sum(F.lit(r)).alias("restricted"))
    both = one(speeding(spark, d, **_shown_days()), 1, 0).unionByName(one(restricted(spark, d, **_shown_days()), 0, 1))
    return both.groupBy("tunnel").agg(F.sum("speeding").alias("speeding"), F.sum("restricted").alias("restricted")).orderBy(F.desc("restricted"), F.desc("speeding"), "tunnel")


@R.add("Q33_devices", f"SELECT tunnel_id, sensor_id, device_id, device_serial AS serial, position, status, detections, missed, duplicates, round(uptime_s / 3600, 1) AS uptime_h, last_report_ts::VARCHAR AS last_report FROM {_LATEST.format(_IN)} ORDER BY tunnel_id, position LIMIT 500")
def q33(spark, d):
    rows = latest_health(binding.health(spark, d)).where(shown()).orderBy("tunnel_id", "position").limit(500)
    return rows.select("tunnel_id", "sensor_id", "device_id", F.col("device_serial").alias("serial"), "position", "status", "detections", "missed", "duplicates", F.round(F.col("uptime_s") / 3600, 1).alias("uptime_h"), F.col("last_report_ts").cast("string").alias("last_report"))


@R.add("Q34_detections_per_device", f"SELECT date_trunc('hour', ts) AS time, sensor_id, count(*) AS detections FROM detections WHERE ts {_RANGE} AND {_IN} GROUP BY ALL")
def q34(spark, d):
    return binding.detections(spark, d).where(in_range("ts") & shown()).groupBy(bucket("hour", "ts").alias("time"), "sensor_id").agg(F.count(F.lit(1)).alias("detections"))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    rows = hour_states(spark, d).groupBy(local_time("hour").alias("local_hour"), "tunnel_id", F.col("classification").alias("vehicle_type"))
    return rows.agg(F.sum("vehicles").alias("vehicles"), rollup.merged_average("speed_avg").alias("speed_avg_kmh"))


def daily(spark: SparkSession, d: str) -> DataFrame:
    rows = hour_states(spark, d).groupBy(F.to_date(local_time("hour")).alias("local_day"), "tunnel_id", F.col("classification").alias("vehicle_type"))
    return rows.agg(F.sum("vehicles").alias("vehicles"), rollup.merged_average("speed_avg").alias("speed_avg_kmh"))


_HOURLY = f"(SELECT hour + INTERVAL 3 HOUR AS local_hour, tunnel_id, classification AS vehicle_type, count(*) AS vehicles, avg(speed_kmh) AS speed_avg_kmh FROM {_HOUR} GROUP BY ALL)"
_DAILY = f"(SELECT (hour + INTERVAL 3 HOUR)::DATE AS local_day, tunnel_id, classification AS vehicle_type, count(*) AS vehicles, avg(speed_kmh) AS speed_avg_kmh FROM {_HOUR} GROUP BY ALL)"


@R.add("Q35_types_per_hour", f"SELECT local_hour AS time, vehicle_type, sum(vehicles)::BIGINT AS vehicles FROM {_HOURLY} WHERE local_hour > TIMESTAMP '{NOW}' - INTERVAL 30 DAY AND {_IN} GROUP BY ALL")
def q35(spark, d):
    rows = hourly(spark, d).where((F.col("local_hour") > moment(NOW) - F.make_dt_interval(F.lit(30))) & shown())
    return rows.groupBy(F.col("local_hour").alias("time"), "vehicle_type").agg(F.sum("vehicles").alias("vehicles"))


@R.add("Q36_types_per_day", f"SELECT local_day::VARCHAR AS time, vehicle_type, sum(vehicles)::BIGINT AS vehicles FROM {_DAILY} WHERE local_day > DATE '2024-01-20' - 30 AND {_IN} GROUP BY ALL")
def q36(spark, d):
    rows = daily(spark, d).where((F.col("local_day") > F.date_sub(F.to_date(moment(NOW)), 30)) & shown())
    return rows.groupBy(F.col("local_day").cast("string").alias("time"), "vehicle_type").agg(F.sum("vehicles").alias("vehicles"))


def _weighted() -> Column:
    # what sums in some order leave behind the ninth digit must not decide a tie
    return F.round(F.round(ratio(F.sum(F.col("vehicles") * F.col("speed_avg_kmh")), F.sum("vehicles")), 9), 4)


@R.add("Q37_speed_per_hour", f"SELECT local_hour AS time, tunnel_id, round(sum(vehicles * speed_avg_kmh) / greatest(sum(vehicles), 1), 4) AS speed FROM {_HOURLY} WHERE {_IN} GROUP BY ALL")
def q37(spark, d):
    return hourly(spark, d).where(shown()).groupBy(F.col("local_hour").alias("time"), "tunnel_id").agg(_weighted().alias("speed"))


@R.add("Q38_speed_per_day", f"SELECT local_day::VARCHAR AS time, tunnel_id, round(sum(vehicles * speed_avg_kmh) / greatest(sum(vehicles), 1), 4) AS speed FROM {_DAILY} WHERE {_IN} GROUP BY ALL")
def q38(spark, d):
    return daily(spark, d).where(shown()).groupBy(F.col("local_day").cast("string").alias("time"), "tunnel_id").agg(_weighted().alias("speed"))


@R.add("Q39_profiles", "SELECT tunnel_id, name, city, city_code::INT AS city_code, round(length_m::DOUBLE) AS length_m, lanes_per_direction::INT AS lanes, speed_limit_kmh::DOUBLE AS limit_kmh FROM profiles")
def q39(spark, d):
    return domain.profiles(spark).select("tunnel_id", "name", "city", "city_code", F.round("length_m").alias("length_m"), F.col("lanes_per_direction").alias("lanes"), F.col("speed_limit_kmh").alias("limit_kmh")).orderBy("tunnel_id")


@R.add("Q40_rules", f"SELECT tunnel_id, vehicle_type, {_HM} AS banned_window FROM rules")
def q40(spark, d):
    return domain.rules(spark).select("tunnel_id", "vehicle_type", F.concat(hhmm(F.col("from_minute")), F.lit("-"), hhmm(F.col("to_minute"))).alias("banned_window")).orderBy("tunnel_id", "vehicle_type")


@R.add("Q41_speeding_today", f"SELECT count(*) AS value, count(*) > 0 AS firing FROM {_SPEEDING} WHERE local_day = DATE '2024-01-20'")
def q41(spark, d):
    return speeding(spark, d, **_today()).where(F.col("local_day") == F.to_date(moment(NOW))).agg(F.count(F.lit(1)).alias("value"), (F.count(F.lit(1)) > 0).alias("firing"))


@R.add("Q42_restricted_today", f"SELECT count(*) AS value, count(*) > 0 AS firing FROM {_RESTRICTED} WHERE local_day = DATE '2024-01-20'")
def q42(spark, d):
    return restricted(spark, d, **_today()).where(F.col("local_day") == F.to_date(moment(NOW))).agg(F.count(F.lit(1)).alias("value"), (F.count(F.lit(1)) > 0).alias("firing"))


@R.add("Q43_prune_counts", "SELECT count(*) FILTER (tunnel_id IN (SELECT tunnel_id FROM profiles)) AS keep, count(*) FILTER (tunnel_id NOT IN (SELECT tunnel_id FROM profiles)) AS purge FROM vehicles")
def q43(spark, d):
    known = domain.profiles(spark).select("tunnel_id", F.lit(True).alias("known"))
    rows = binding.vehicles(spark, d).join(alerts.dimension(known), "tunnel_id", "left")
    return rows.agg(F.count_if(F.col("known").isNotNull()).alias("keep"), F.count_if(F.col("known").isNull()).alias("purge"))


@R.add("Q44_profile_ids", "SELECT string_agg(tunnel_id, ',' ORDER BY tunnel_id) AS tunnels FROM profiles")
def q44(spark, d):
    return domain.profiles(spark).agg(F.array_join(F.array_sort(F.collect_list("tunnel_id")), ",").alias("tunnels"))


@R.add("V1_vehicles_dedup", "SELECT tunnel_id, event_id, ts_entry, speed_kmh, inserted_at, kafka_offset FROM dedup")
def v1(spark, d):
    return vehicles_dedup(binding.vehicles(spark, d)).select("tunnel_id", "event_id", "ts_entry", "speed_kmh", "inserted_at", "kafka_offset")


def _stats_sql(unit: str, alpha: float) -> str:
    g = (1 + alpha) / (1 - alpha)
    keys = f"{unit}, tunnel_id, direction, classification"
    picks = ", ".join(f"round(min(CASE WHEN upto >= greatest(1, ceil({q} * whole)) THEN coalesce(2 * pow({g!r}::DOUBLE, b) / ({g!r}::DOUBLE + 1), 0) END), 6) AS speed_p{round(q * 100)}_kmh" for q in rollup.QUANTILES)
    return f"""WITH r AS (SELECT *, date_trunc('{unit}', ts_entry) AS {unit}, CASE WHEN speed_kmh > 0 THEN ceil(ln(speed_kmh) / {rollup.math.log(g)!r}::DOUBLE)::INT END AS b FROM firsts),
      s AS (SELECT {keys}, b, count(*) AS n FROM r GROUP BY ALL),
      c AS (SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY b NULLS FIRST) AS upto, sum(n) OVER (PARTITION BY {keys}) AS whole FROM s),
      q AS (SELECT {keys}, {picks} FROM c GROUP BY {keys}),
      a AS (SELECT {keys}, count(*) AS vehicles, round(avg(speed_kmh), 6) AS speed_avg_kmh, min(speed_kmh) AS speed_min_kmh, max(speed_kmh) AS speed_max_kmh, round(avg(length_m), 6) AS length_avg_m FROM r GROUP BY {keys})
      SELECT * FROM a JOIN q USING ({keys})"""


def _stats(states: DataFrame, unit: str) -> DataFrame:
    f = rollup.finalised(states, unit, whole=True)  # of one rollup: a key has one state
    rounded = [F.round(c, 6).alias(c) if c.endswith(("_avg_kmh", "_avg_m")) or "_p" in c else F.col(c) for c in f.columns]
    return f.select(*rounded)


@R.add("V2_minute_stats", _stats_sql("minute", 0.02))
def v2(spark, d):
    return _stats(minute_states(spark, d), "minute")


@R.add("V3_hour_stats", _stats_sql("hour", 0.01))
def v3(spark, d):
    return _stats(hour_states(spark, d), "hour")


@R.add("V4_speeding_alerts", f"SELECT * REPLACE (local_day::VARCHAR AS local_day) FROM {_SPEEDING}")
def v4(spark, d):
    return speeding(spark, d).withColumn("local_day", F.col("local_day").cast("string"))


@R.add("V5_restricted_alerts", f"SELECT * REPLACE (local_day::VARCHAR AS local_day) FROM {_RESTRICTED}")
def v5(spark, d):
    return restricted(spark, d).withColumn("local_day", F.col("local_day").cast("string"))


@R.add("V6_types_hourly", f"SELECT * REPLACE (round(speed_avg_kmh, 6) AS speed_avg_kmh) FROM {_HOURLY}")
def v6(spark, d):
    return hourly(spark, d).withColumn("speed_avg_kmh", F.round("speed_avg_kmh", 6))


@R.add("V7_types_daily", f"SELECT * REPLACE (round(speed_avg_kmh, 6) AS speed_avg_kmh, local_day::VARCHAR AS local_day) FROM {_DAILY}")
def v7(spark, d):
    return daily(spark, d).withColumns({"speed_avg_kmh": F.round("speed_avg_kmh", 6), "local_day": F.col("local_day").cast("string")})


@R.add("V8_device_health_latest", f"SELECT * FROM {_LATEST.format('true')}")
def v8(spark, d):
    return latest_health(binding.health(spark, d))
