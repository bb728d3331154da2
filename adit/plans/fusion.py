"""Fusion, validation and stream semantics as queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adit.operators.dedup import by_sequence, first_seen
from adit.operators.lineage import checkpointed
from adit.operators.validate import rejected_late, split_3way, strict_detections, validated
from adit.plans import Registry
from adit.sources import binding, domain
from adit.streaming import fusion

R = Registry()
HALF_M = 500.0


def sensed(spark, d):
    """Detections of each event's vehicle at three sensors 500 m apart, some missing, some repeated."""
    i = F.col("event_id")
    e = binding.events(spark, d).select("event_id", "user_id", F.timestamp_diff("MILLISECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col("ts")).alias("t0"), F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("index"))
    tunnel = F.element_at(F.array(*map(F.lit, binding.TUNNELS)), (F.col("user_id") % 6 + 1).cast("int"))
    position = F.element_at(F.array(*map(F.lit, domain.POSITIONS)), (F.col("index") + 1).cast("int"))
    kept = e.where(~((F.col("index") == 1) & (i % 11 == 0)) & ~((F.col("index") == 2) & (i % 13 == 0)))
    rows = kept.select(
        tunnel.alias("tunnel_id"), F.concat(tunnel, F.lit("-"), position).alias("sensor_id"), F.lit("b").alias("boot_id"), i.alias("seq"), position.alias("position"),
        (F.col("t0") + F.col("index") * 25_000).alias("ts"), F.lit("start_to_end").alias("direction"), (i % 3 + 1).cast("int").alias("lane"), F.concat(F.lit("34 AA "), i.cast("string")).alias("plate"),
        F.lit(72.0).alias("speed_kmh"), F.lit(4.5).alias("length_m"), F.lit(0.9).alias("confidence"), F.element_at(F.array(*map(F.lit, domain.CLASSES)), (i % 9 + 1).cast("int")).alias("classification"),
        F.concat_ws(":", tunnel, position, i.cast("string")).alias("message_id"), (F.col("t0") + F.col("index") * 25_000).alias("arrival"),
    )
    return rows.unionByName(rows.where("seq % 17 = 0").withColumn("arrival", F.col("arrival") + 100))


_FUSED = """SELECT tunnel_id, count(*) AS vehicles, sum(sensors)::BIGINT AS detections, count(*) FILTER (sensors = 3) AS whole FROM (
  SELECT (['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] AS tunnel_id, 3 - (event_id % 11 = 0)::INT - (event_id % 13 = 0)::INT AS sensors FROM events) GROUP BY 1"""


@R.add("st_fuse_batch", _FUSED)
def st_fuse_batch(spark, d):
    known = spark.createDataFrame([(t, HALF_M) for t in binding.TUNNELS], "tunnel_id string, half_m double")
    events = fusion.fuse(sensed(spark, d), known)
    return events.groupBy("tunnel_id").agg(F.count(F.lit(1)).alias("vehicles"), F.sum(F.col("sensors").cast("bigint")).alias("detections"), F.count_if(F.col("sensors") == 3).alias("whole"))


@R.add(
    "st_fuse_events",
    """SELECT (['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] AS tunnel_id, (['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] || ':start:' || event_id AS event_id,
  (event_id % 3 + 1)::INT AS lane, epoch_us(ts) // 1000 AS ts_entry, epoch_us(ts) // 1000 + 50000 AS ts_exit, '34 AA ' || event_id AS plate, 72.0::DOUBLE AS speed_kmh,
  (['MOTOSIKLET','OTOMOBIL','HAFIF_TICARI','MINIBUS','OTOBUS','KAMYON','CEKICI_YARI_ROMORK','TRAKTOR','OZEL_AMACLI_TASIT'])[event_id % 9 + 1] AS classification,
  CASE WHEN event_id % 143 = 0 THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence, 1.0::DOUBLE AS agreement, 3 - (event_id % 11 = 0)::INT - (event_id % 13 = 0)::INT AS sensors,
  CASE WHEN event_id % 143 = 0 THEN 'middle,end' WHEN event_id % 11 = 0 THEN 'middle' WHEN event_id % 13 = 0 THEN 'end' ELSE '' END AS missing FROM events""",
)
def st_fuse_events(spark, d):
    known = spark.createDataFrame([(t, HALF_M) for t in binding.TUNNELS], "tunnel_id string, half_m double")
    return fusion.fuse(sensed(spark, d), known).select(
        "tunnel_id", "event_id", "lane", "ts_entry", "ts_exit", "plate", "speed_kmh", "classification", "confidence", "agreement", "sensors", F.array_join("missing", ",").alias("missing")
    )


@R.add("st_dedup_seq", "SELECT 'x' AS k, count(*) * 3 - count(*) FILTER (event_id % 11 = 0) - count(*) FILTER (event_id % 13 = 0) AS kept FROM events")
def st_dedup_seq(spark, d):
    return by_sequence(sensed(spark, d)).agg(F.lit("x").alias("k"), F.count(F.lit(1)).alias("kept"))


@R.add(
    "st_dedup_seq_window",
    """WITH sent AS (
  SELECT event_id AS arrival, 's' || (user_id % 6) AS sensor_id, 'b' || (event_id // 700 % 3) AS boot_id,
         CASE WHEN event_id % 10 = 3 THEN event_id - 1 WHEN event_id % 41 = 0 THEN greatest(event_id - 600, 0) WHEN event_id % 13 = 0 THEN event_id // 7 * 7 ELSE event_id END AS seq FROM events),
runs AS (SELECT *, sum(began) OVER (PARTITION BY sensor_id ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS run FROM (
  SELECT *, coalesce((boot_id <> lag(boot_id) OVER (PARTITION BY sensor_id ORDER BY arrival))::INT, 0) AS began FROM sent)),
marked AS (SELECT *, max(seq) OVER (PARTITION BY sensor_id, run ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top,
  row_number() OVER (PARTITION BY sensor_id, run, seq ORDER BY arrival) AS again FROM runs)
SELECT sensor_id, boot_id, count(*) AS kept, sum(seq)::BIGINT AS numbers FROM marked WHERE again = 1 AND (top IS NULL OR seq > top - 512) GROUP BY ALL""",
)
def st_dedup_seq_window(spark, d):
    # repeats, numbers too far behind, and boots that change and come back
    i = F.col("event_id")
    seq = F.when(i % 10 == 3, i - 1).when(i % 41 == 0, F.greatest(i - 600, F.lit(0))).when(i % 13 == 0, F.floor(i / 7) * 7).otherwise(i)
    sent = binding.events(spark, d).select(
        i.alias("arrival"), i.cast("string").alias("message_id"), F.concat(F.lit("s"), (F.col("user_id") % 6).cast("string")).alias("sensor_id"), F.concat(F.lit("b"), (F.floor(i / 700) % 3).cast("string")).alias("boot_id"), seq.alias("seq")
    )
    return by_sequence(sent).groupBy("sensor_id", "boot_id").agg(F.count(F.lit(1)).alias("kept"), F.sum("seq").alias("numbers"))


@R.add("st_first_seen_dedup", "SELECT tunnel_id, count(*) AS events, round(sum(speed_kmh), 4) AS speed FROM firsts GROUP BY 1")
def st_first_seen(spark, d):
    v = first_seen(binding.vehicles(spark, d), "event_id", ["kafka_partition", "kafka_offset"])
    return v.groupBy("tunnel_id").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("speed_kmh"), 4).alias("speed"))


@R.add("st_windows", "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def st_windows(spark, d):
    return binding.events(spark, d).groupBy(F.window("ts", "1 minute").getField("start").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def enveloped(spark, d, *keep):
    """Each event as a raw envelope; some are broken in one of five ways."""
    i = F.col("event_id")
    tunnel = F.element_at(F.array(*map(F.lit, binding.TUNNELS)), (F.col("user_id") % 6 + 1).cast("int"))
    payload = F.to_json(
        F.struct(
            F.when(i % 10 == 1, 1).otherwise(2).alias("schema"), F.concat(F.lit("m:b:"), i.cast("string")).alias("message_id"), F.concat(tunnel, F.lit("-start")).alias("sensor_id"), F.lit("02:00").alias("device_id"),
            F.lit("TSN").alias("device_serial"), F.when(i % 10 == 2, "elsewhere").otherwise(tunnel).alias("tunnel_id"), F.lit("start").alias("position"), F.lit("").alias("plate"), i.alias("seq"), F.lit(1_700_000_000_000).alias("ts"),
            F.lit(1).alias("lane"), F.lit(5).alias("occupancy_ms"), F.lit(72.5).alias("speed_kmh"), F.lit(4).alias("length_m"), F.lit(0.9).alias("confidence"), F.lit("end_to_start").alias("direction"),
            F.when(i % 10 == 3, "bus").otherwise("OTOMOBIL").alias("classification"),
        )
    )
    topic = F.concat(F.lit("tunnels/"), tunnel, F.lit("/sensors/"), F.when(i % 10 == 4, "side").otherwise("start"), F.lit("/detections"))
    e = F.to_json(F.struct(topic.alias("topicName"), F.base64(payload.cast("binary")).alias("payload"), F.lit(1_700_000_000_001).alias("ts"), F.when(i % 10 == 5, "other").otherwise(tunnel).alias("clientCertCn")))
    # few and narrow columns are dealt out before the heavy work: a small table is one split
    rows = binding.events(spark, d).select("event_id", "user_id").repartition(spark.sparkContext.defaultParallelism, "event_id")
    return rows.select("event_id", *keep, F.regexp_replace(e, r"\\r\\n", "").cast("binary").alias("value"))


_REASON = "CASE event_id % 10 WHEN 1 THEN 'unsupported_schema' WHEN 2 THEN 'payload_mismatch' WHEN 3 THEN 'bad_payload' WHEN 4 THEN 'bad_topic' WHEN 5 THEN 'identity_mismatch' END"


@R.add("val_first_reason", f"SELECT event_id, {_REASON} AS reason, CASE WHEN {_REASON} IS NULL THEN 'detection' ELSE 'rejected' END AS kind FROM events")
def val_first_reason(spark, d):
    return validated(enveloped(spark, d)).select("event_id", "reason", "kind")


_TUNNEL = "(['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1]"


_DETAIL = f"CASE event_id % 10 WHEN 1 THEN 'schema 1 (supported: 2)' WHEN 2 THEN 'payload tunnel_id/position/sensor_id ''elsewhere''/''start''/''' || {_TUNNEL} || '-start'' != topic ''' || {_TUNNEL} || '''/''start''/''' || {_TUNNEL} || '-start''' WHEN 3 THEN 'field ''classification'' must be one of BILINMEYEN|CEKICI_YARI_ROMORK|HAFIF_TICARI|KAMYON|MINIBUS|MOTOSIKLET|OTOBUS|OTOMOBIL|OZEL_AMACLI_TASIT|TRAKTOR' WHEN 4 THEN 'topic is not tunnels/{{tunnel_id}}/sensors/{{start|middle|end}}/{{detections|health}}' WHEN 5 THEN 'clientCertCn ''other'' != topic tunnel_id ''' || {_TUNNEL} || '''' END"


@R.add("val_explain_all", f"SELECT event_id, {_DETAIL} AS detail FROM events")
def val_explain_all(spark, d):
    # of every event, those built from values too
    return validated(enveloped(spark, d)).select("event_id", "detail")


@R.add("sink_split_3way", "SELECT CASE WHEN event_id % 10 BETWEEN 1 AND 5 THEN 'rejected' ELSE 'detection' END AS kind, count(*) AS n, count(DISTINCT CASE WHEN event_id % 10 <> 4 THEN user_id % 6 END) AS keys FROM events GROUP BY 1")
def sink_split_3way(spark, d):
    parts = split_3way(checkpointed(validated(enveloped(spark, d))))
    one = lambda kind: parts[kind].groupBy(F.lit(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("keys"))
    return one("detection").unionByName(one("rejected")).unionByName(one("health"))


def enveloped_all(spark, d):
    """Each event as a raw envelope of either topic: the five faults, health reports, and no envelopes at all."""
    i = F.col("event_id")
    good = enveloped(spark, d, "user_id")
    tunnel = F.element_at(F.array(*map(F.lit, binding.TUNNELS)), (F.col("user_id") % 6 + 1).cast("int"))
    report = F.to_json(
        F.struct(
            F.lit(2).alias("schema"), F.concat(tunnel, F.lit("-end")).alias("sensor_id"), F.lit("02:01").alias("device_id"), F.lit("TSN").alias("device_serial"), tunnel.alias("tunnel_id"), F.lit("end").alias("position"),
            F.lit(1_700_000_000_000).alias("ts"), F.when(i % 20 == 7, "asleep").otherwise("ok").alias("status"), F.when(i % 20 != 8, True).alias("degraded"), F.lit(60).alias("window_s"), F.lit(1.5).alias("uptime_s"),
            i.alias("detections"), F.lit(0).alias("duplicates"), F.lit(1).alias("missed"),
        )
    )
    health = F.to_json(F.struct(F.concat(F.lit("tunnels/"), tunnel, F.lit("/sensors/end/health")).alias("topicName"), F.base64(report.cast("binary")).alias("payload"), F.lit(1_700_000_000_001).alias("ts"), tunnel.alias("clientCertCn")))
    health = F.regexp_replace(health, r"\\r\\n", "")
    value = F.when(i % 20 == 6, F.lit(None).cast("binary")).when(i % 20 == 16, F.lit("{nothing").cast("binary")).when(i % 20 == 9, F.lit("[1]").cast("binary"))
    return good.select("event_id", "user_id", value.when((i % 20).isin(7, 8, 17, 18), health.cast("binary")).otherwise(F.col("value")).alias("value"))


_REASON_ALL = f"CASE WHEN event_id % 20 IN (6, 9, 16) THEN 'bad_envelope' WHEN event_id % 20 IN (7, 8) THEN 'bad_payload' WHEN event_id % 20 IN (17, 18) THEN NULL ELSE {_REASON} END"


@R.add(
    "val_reasons_all",
    f"""SELECT event_id, {_REASON_ALL} AS reason, CASE WHEN {_REASON_ALL} IS NOT NULL THEN 'rejected' WHEN event_id % 20 IN (17, 18) THEN 'health' ELSE 'detection' END AS kind,
  CASE event_id % 20 WHEN 6 THEN 'record value is null' WHEN 16 THEN 'envelope is not valid UTF-8 JSON' WHEN 9 THEN 'envelope is not a JSON object' WHEN 8 THEN 'missing field ''degraded''' WHEN 7 THEN 'field ''status'' must be one of degraded|ok|silent' END AS detail
  FROM events""",
)
def val_reasons_all(spark, d):
    checked = validated(enveloped_all(spark, d))
    return checked.select("event_id", "reason", "kind", F.when((F.col("event_id") % 20).isin(6, 7, 8, 9, 16), F.col("detail")).alias("detail"))


@R.add(
    "val_explain",
    f"""SELECT event_id, CASE WHEN event_id % 20 = 6 THEN 'record value is null' WHEN event_id % 20 = 16 THEN 'envelope is not valid UTF-8 JSON' WHEN event_id % 20 = 9 THEN 'envelope is not a JSON object'
  WHEN event_id % 20 = 8 THEN 'missing field ''degraded''' WHEN event_id % 20 = 7 THEN 'field ''status'' must be one of degraded|ok|silent' WHEN event_id % 20 IN (17, 18) THEN NULL ELSE {_DETAIL} END AS detail FROM events""",
)
def val_explain(spark, d):
    # of every event of either topic
    return validated(enveloped_all(spark, d)).select("event_id", "detail")


@R.add(
    "val_reject_late",
    f"SELECT event_id, CASE WHEN event_id % 20 IN (6, 9, 16) THEN NULL ELSE {_TUNNEL} END AS key, 'too_large' AS reason, CASE WHEN event_id % 20 IN (6, 9, 16) THEN NULL WHEN event_id % 20 IN (7, 8, 17, 18) THEN 'tunnels/' || {_TUNNEL} || '/sensors/end/health' WHEN event_id % 10 = 4 THEN 'tunnels/' || {_TUNNEL} || '/sensors/side/detections' ELSE 'tunnels/' || {_TUNNEL} || '/sensors/start/detections' END AS topic FROM events",
)
def val_reject_late(spark, d):
    # what was valid and could not be written after all
    return rejected_late(enveloped_all(spark, d), "too_large", "refused by the producer").select("event_id", "key", "reason", F.get_json_object("record", "$.topic").alias("topic"))


@R.add(
    "parse_detection_strict",
    """SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'unsupported schema 3' WHEN event_id % 19 = 0 THEN 'bad direction/position ''up''/''middle''' WHEN event_id % 23 = 0 THEN 'bad classification ''TANK'''
  WHEN event_id % 29 = 0 THEN 'speed_kmh must be > 0' END AS invalid, CASE WHEN event_id % 31 = 0 THEN '' ELSE 'b' || (user_id % 2) END AS boot_id FROM events""",
)
def parse_detection_strict(spark, d):
    i = F.col("event_id")
    rows = binding.events(spark, d).select(
        "event_id", F.when(i % 17 == 0, 3).otherwise(2).alias("schema"), F.when(i % 31 == 0, "unnumbered").otherwise(F.concat(F.lit("T:1:middle:b"), (F.col("user_id") % 2).cast("string"), F.lit(":"), i.cast("string"))).alias("message_id"),
        F.when(i % 19 == 0, "up").otherwise("end_to_start").alias("direction"), F.lit("middle").alias("position"), F.when(i % 23 == 0, "TANK").otherwise("OTOBUS").alias("classification"), F.when(i % 29 == 0, 0.0).otherwise(50.0).alias("speed_kmh"),
    )
    return strict_detections(rows).select("event_id", "invalid", "boot_id")


@R.add(
    "st_calibrate",
    """WITH s AS (SELECT (['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] AS tunnel_id, epoch_us(ts) // 1000 AS t, event_id FROM events),
b AS (SELECT tunnel_id, min(t) AS began FROM s GROUP BY 1),
v AS (SELECT tunnel_id, ((event_id % 11 <> 0 AND t + 25000 < began + 21600000)::INT + (event_id % 11 <> 0 AND event_id % 13 <> 0 AND t + 50000 < began + 21600000)::INT) AS votes FROM s JOIN b USING (tunnel_id))
SELECT tunnel_id, 500.0::DOUBLE AS half_m FROM v GROUP BY 1 HAVING sum(votes) >= 8""",
)
def st_calibrate(spark, d):
    return fusion.calibrated(fusion.placed(by_sequence(sensed(spark, d)))).select("tunnel_id", F.round("half_m", 6).alias("half_m"))


@R.add(
    "agg_totals_counters",
    "SELECT name, sum(n)::BIGINT AS n FROM (SELECT unnest(['received', 'errors', 'users']) AS name, unnest([count(*), count(*) FILTER (event_type = 'error'), count(DISTINCT user_id)]) AS n FROM events GROUP BY user_id % 6) GROUP BY 1",
)
def agg_totals_counters(spark, d):
    # counters of each worker (a map), summed over all workers
    engines = binding.events(spark, d).groupBy(F.col("user_id") % 6).agg(
        F.create_map(F.lit("received"), F.count(F.lit(1)), F.lit("errors"), F.count_if(F.col("event_type") == "error"), F.lit("users"), F.countDistinct("user_id")).alias("counters")
    )
    return engines.select(F.explode("counters").alias("name", "n")).groupBy("name").agg(F.sum("n").alias("n"))


@R.add(
    "parse_log_remap",
    "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS level, event_id % 3 = 0 AS plain, CASE WHEN event_id % 3 = 0 THEN 'started ' || event_id END AS line, 'pod' || (user_id % 5) AS pod FROM events",
)
def parse_log_remap(spark, d):
    # a line that is JSON becomes its value, any other stays text; metadata that nobody searches by goes
    i = F.col("event_id")
    raw = binding.events(spark, d).select(
        "event_id", F.when(i % 3 == 0, F.concat(F.lit("started "), i.cast("string"))).otherwise(F.to_json(F.struct(F.col("event_type").alias("level")))).alias("message"),
        F.struct(F.concat(F.lit("pod"), (F.col("user_id") % 5).cast("string")).alias("pod"), F.lit("u").alias("pod_uid"), F.lit("c").alias("container_id")).alias("kubernetes"), F.lit("/var/log").alias("file"),
    )
    rows = raw.withColumn("log", F.coalesce(F.try_parse_json("message"), F.col("message").cast("variant"))).drop("message", "file").withColumn("kubernetes", F.col("kubernetes").dropFields("pod_uid", "container_id"))
    plain = F.schema_of_variant("log") == "STRING"
    return rows.select("event_id", F.try_variant_get("log", "$.level", "string").alias("level"), plain.alias("plain"), F.when(plain, F.try_variant_get("log", "$", "string")).alias("line"), F.col("kubernetes.pod").alias("pod"))


def varied(spark, d):
    """What three sensors 500 m apart see of each event's vehicle, with its own speed and length; a third of the plates is unread."""
    i, k = F.col("event_id"), F.col("index")
    tunnel = F.element_at(F.array(*map(F.lit, binding.TUNNELS)), (F.col("user_id") % 6 + 1).cast("int"))
    ms = F.floor(F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col("ts")) / 1000)
    e = binding.events(spark, d).select("event_id", tunnel.alias("tunnel_id"), ms.alias("ms"), F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("index"))
    return e.select(
        "tunnel_id", F.lit("start_to_end").alias("direction"), (i % 3 + 1).cast("int").alias("lane"), "index", ((F.col("ms") + k * 25_000) / 1000).alias("t"),
        (F.lit(20.0) + i % 7 * F.lit(0.125) + k * F.lit(0.0625)).alias("speed"), (F.lit(9.0) + i % 5 * F.lit(0.25) + k * F.lit(0.125)).alias("length_m"), F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("P"), i.cast("string"))).alias("plate"),
    )


_VARIED = """e AS (SELECT event_id, (['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] AS tunnel_id, epoch_us(ts) // 1000 AS ms, unnest([0, 1, 2]) AS k FROM events),
 s AS (SELECT tunnel_id, event_id % 3 AS lane, k, (ms + k * 25000) / 1000.0::DOUBLE AS t, 20::DOUBLE + event_id % 7 * 0.125::DOUBLE + k * 0.0625::DOUBLE AS speed, 9::DOUBLE + event_id % 5 * 0.25::DOUBLE + k * 0.125::DOUBLE AS length_m, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'P' || event_id END AS plate FROM e),
 p AS (SELECT a.tunnel_id, (b.t - a.t) * ((a.speed + b.speed) / 2) AS half, (a.speed + b.speed) / 2 AS v, a.speed - b.speed AS ds, a.length_m - b.length_m AS dl, b.plate <> '' AND a.plate = b.plate AS same
   FROM s a JOIN s b ON a.tunnel_id = b.tunnel_id AND a.lane = b.lane AND b.k = a.k + 1 AND b.t > a.t AND b.t <= a.t + 2250 WHERE a.plate = '' OR b.plate = '' OR a.plate = b.plate),
 w AS (SELECT tunnel_id, half, CASE WHEN same THEN 1 ELSE exp(-(pow(ds / (0.06::DOUBLE * v), 2) + pow(dl / 1.5::DOUBLE, 2)) / 2) END AS weight FROM p WHERE half BETWEEN 50 AND 12500),
 h AS (SELECT tunnel_id, floor(ln(half) / ln(1.01::DOUBLE))::INT AS bin, sum(weight) AS weight, sum(weight * half) AS mass FROM w WHERE weight >= 0.01 GROUP BY ALL)"""


@R.add("st_spacing_votes", f"WITH {_VARIED} SELECT tunnel_id, bin, round(weight, 4) AS weight, round(mass / weight, 3) AS mean FROM h")
def st_spacing_votes(spark, d):
    votes = fusion.spacing_votes(varied(spark, d))
    return votes.select("tunnel_id", "bin", F.round("weight", 4).alias("weight"), F.round(F.col("mass") / F.col("weight"), 3).alias("mean"))


@R.add(
    "st_spacing_peaks",
    f"""WITH {_VARIED}, n AS (SELECT a.tunnel_id, a.bin, sum(b.weight) AS height, sum(b.mass) AS mass FROM h a JOIN h b ON a.tunnel_id = b.tunnel_id AND b.bin BETWEEN a.bin - 3 AND a.bin + 3 GROUP BY ALL),
 t AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY tunnel_id ORDER BY height DESC, bin) = 1),
 r AS (SELECT t.tunnel_id, t.height, t.mass, max(CASE WHEN abs(n.bin - t.bin) > 9 THEN n.height END) AS rival FROM t JOIN n USING (tunnel_id) GROUP BY ALL)
 SELECT tunnel_id, round(mass / height, 3) AS half_m FROM r WHERE height >= 8 AND height >= 2.5 * coalesce(rival, 0)""",
)
def st_spacing_peaks(spark, d):
    return fusion.spacing_peaks(checkpointed(fusion.spacing_votes(varied(spark, d)))).select("tunnel_id", F.round("half_m", 3).alias("half_m"))


@R.add(
    "st_traffic_report",
    f"""WITH e AS (SELECT {_TUNNEL} AS tunnel_id, epoch_us(ts) // 60000000 * 60 AS "window", CASE WHEN event_id % 2 = 0 THEN 'start_to_end' ELSE 'end_to_start' END || '/' || (['MOTOSIKLET','OTOMOBIL','HAFIF_TICARI'])[event_id % 3 + 1] AS kind FROM events),
 c AS (SELECT "window", tunnel_id, kind, count(*) AS n FROM e GROUP BY ALL), r AS (SELECT "window", tunnel_id, sum(n)::BIGINT AS vehicles, string_agg(kind || '=' || n, ',' ORDER BY kind) AS counts FROM c GROUP BY ALL),
 a AS (SELECT unnest(range((SELECT min("window") FROM e), (SELECT max("window") FROM e) + 60, 60)) AS "window"), t AS (SELECT unnest(['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005','IDLE']) AS tunnel_id)
 SELECT "window", tunnel_id, coalesce(vehicles, 0) AS vehicles, coalesce(counts, '') AS counts FROM a CROSS JOIN t LEFT JOIN r USING ("window", tunnel_id)""",
)
def st_traffic_report(spark, d):
    # every tunnel in every minute, one that never reports too
    i = F.col("event_id")
    e = binding.events(spark, d).select(
        F.element_at(F.array(*map(F.lit, binding.TUNNELS)), (F.col("user_id") % 6 + 1).cast("int")).alias("tunnel_id"), F.floor(F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col("ts")) / 1000).alias("ts_entry"),
        F.when(i % 2 == 0, "start_to_end").otherwise("end_to_start").alias("direction"), F.element_at(F.array(*map(F.lit, domain.CLASSES)), (i % 3 + 1).cast("int")).alias("classification"), F.lit(60.0).alias("speed_kmh"), F.lit(True).alias("learned"),
    )
    tunnels = spark.createDataFrame([(t,) for t in (*binding.TUNNELS, "IDLE")], "tunnel_id string")
    entries = F.transform(F.array_sort(F.map_entries("counts")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return fusion.traffic_report(e, 60, tunnels).select("window", "tunnel_id", "vehicles", F.array_join(entries, ",").alias("counts"))
