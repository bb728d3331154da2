"""Joins, aggregations, top-k, sets, projections and scalar functions, each as a query of its own."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adit.functions.scalar import bucket, hhmm, in_window, local_time, map_total, millis_between, minute_of_day, plate_body, ratio, strict_base64
from adit.operators import counters, dedup, pairing, quantiles, rollup
from adit.operators.alerts import dimension
from adit.plans import Registry
from adit.plans.dashboards import hour_states, minute_states, speeding
from adit.sources import binding, domain
from adit.streaming.fusion import WINDOW_S

R = Registry()


def events(spark: SparkSession, d: str) -> DataFrame:
    return binding.events(spark, d)


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---- sources and projections ----


@R.add("src_table_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-02-01'")
def src_table_scan(spark, d):
    rows = read(spark, d, "lineitem").where((F.col("l_shipdate") >= F.lit("1997-01-01").cast("date")) & (F.col("l_shipdate") < F.lit("1997-02-01").cast("date")))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


@R.add("src_compacted_topic", "SELECT key, value FROM (SELECT 't' || user_id AS key, CASE WHEN event_id % 9 = 0 THEN NULL ELSE round(value, 1) END AS value, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 4 DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND value IS NOT NULL")
def src_compacted_topic(spark, d):
    records = events(spark, d).select(F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("key"), F.when(F.col("event_id") % 9 != 0, F.round("value", 1)).alias("value"), (F.col("event_id") % 4).alias("partition"), F.col("event_id").alias("offset"))
    return domain.latest_of_topic(records)


@R.add("src_json_topic", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def src_json_topic(spark, d):
    return events(spark, d).select("event_id", F.from_json("props", "k bigint").getField("k").alias("k"))


@R.add("proj_epoch_ms", "SELECT event_id, epoch_ms(1700000000000 + event_id * 1001) AS at FROM events")
def proj_epoch_ms(spark, d):
    return events(spark, d).select("event_id", F.convert_timezone(F.lit(spark.conf.get("spark.sql.session.timeZone")), F.lit("UTC"), F.timestamp_millis(F.lit(1700000000000) + F.col("event_id") * 1001).cast("timestamp_ntz")).alias("at"))


@R.add("proj_nullable_cast", "SELECT event_id, CASE WHEN event_id % 4 > 0 THEN (event_id * 2)::VARCHAR END AS twice FROM events")
def proj_nullable_cast(spark, d):
    return events(spark, d).select("event_id", (F.when(F.col("event_id") % 4 > 0, F.col("event_id")) * 2).cast("string").alias("twice"))


@R.add("filter_plausible_ts", "SELECT count(*) AS kept FROM events WHERE (event_id % 10) * 200000000000 > 1000000000000")
def filter_plausible_ts(spark, d):
    return events(spark, d).where(F.col("event_id") % 10 * 200_000_000_000 > domain.PLAUSIBLE_MS).agg(F.count(F.lit(1)).alias("kept"))


@R.add("proj_alias_latency", "SELECT message_id, date_sub('millisecond', ts, received_ts) AS mqtt_latency_ms, date_sub('millisecond', received_ts, processed_ts) AS process_latency_ms, date_sub('millisecond', received_ts, inserted_at) AS ingest_latency_ms FROM detections")
def proj_alias_latency(spark, d):
    return binding.detections(spark, d).select("message_id", millis_between("ts", "received_ts").alias("mqtt_latency_ms"), millis_between("received_ts", "processed_ts").alias("process_latency_ms"), millis_between("received_ts", "inserted_at").alias("ingest_latency_ms"))


@R.add("proj_any_of_enum", "SELECT CASE WHEN classification IN ('KAMYON', 'CEKICI_YARI_ROMORK', 'OTOBUS') THEN 'heavy' WHEN classification IN ('HAFIF_TICARI', 'MINIBUS') THEN 'light' WHEN classification = 'OTOMOBIL' THEN 'car' WHEN classification = 'BILINMEYEN' THEN 'unknown' ELSE 'other' END AS kind, count(*) AS n FROM detections GROUP BY 1")
def proj_any_of_enum(spark, d):
    c = F.col("classification")
    kind = F.when(c.isin(*domain.HEAVY), "heavy").when(c.isin(*domain.LIGHT), "light").when(c == "OTOMOBIL", "car").when(c == domain.UNKNOWN, "unknown").otherwise("other")
    return binding.detections(spark, d).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@R.add("proj_reject_record", "SELECT reason, tunnel_id AS key, substring(html, 1, 4096) AS envelope FROM rejected JOIN pages ON record % (SELECT max(page_id) + 1 FROM pages) = page_id")
def proj_reject_record(spark, d):
    pages = read(spark, d, "pages").select("page_id", "html")
    count = pages.agg((F.max("page_id") + 1).alias("pages"))  # one row
    rejected = binding.rejected(spark, d).crossJoin(F.broadcast(count)).withColumn("page_id", F.col("record") % F.col("pages"))
    return rejected.join(pages, "page_id").select("reason", F.col("tunnel_id").alias("key"), F.substring("html", 1, 4096).alias("envelope"))


@R.add("pred_in_list", "SELECT count(*) AS n FROM vehicles WHERE tunnel_id IN ('TR-BOLU', 'TR-OVIT')")
def pred_in_list(spark, d):
    return binding.vehicles(spark, d).where(F.col("tunnel_id").isin("TR-BOLU", "TR-OVIT")).agg(F.count(F.lit(1)).alias("n"))


@R.add("pred_in_subquery", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY 1")
def pred_in_subquery(spark, d):
    rich = read(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return read(spark, d, "orders").join(rich, "o_custkey", "left_semi").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@R.add("pred_not_in_subquery", "SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def pred_not_in_subquery(spark, d):
    buyers = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, d, "customer").join(buyers, "c_custkey", "left_anti").agg(F.count(F.lit(1)).alias("n"))


@R.add("pred_time_range", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' GROUP BY 1")
def pred_time_range(spark, d):
    at = lambda t: F.to_timestamp_ntz(F.lit(t))
    return events(spark, d).where((F.col("ts") >= at("2024-01-10 00:00:00")) & (F.col("ts") < at("2024-01-12 00:00:00"))).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


_MINUTE = "(60 * hour(ts + INTERVAL 3 HOUR) + minute(ts + INTERVAL 3 HOUR))"


@R.add("pred_wraparound_window", f"SELECT event_id FROM events WHERE {_MINUTE} >= 1320 OR {_MINUTE} < 360")
def pred_wraparound_window(spark, d):
    return events(spark, d).where(in_window(minute_of_day(local_time("ts")), F.lit(1320), F.lit(360))).select("event_id")


@R.add("trace_ratio_sampler", "SELECT event_id FROM events WHERE ('0x' || substr(md5(event_id::VARCHAR), 17, 15))::BIGINT < 115292150460684697")
def trace_ratio_sampler(spark, d):
    """Of the low bits of a trace id (60 of them, the rest has no say at this rate), a tenth."""
    low = F.conv(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 17, 15), 16, 10).cast("bigint")
    return events(spark, d).where(low < (1 << 60) // 10 + 1).select("event_id")


@R.add("trace_ratio_sampler_64", "SELECT event_id FROM events WHERE ('0x' || substr(md5(event_id::VARCHAR), 17, 16))::UBIGINT < 1844674407370955162")
def trace_ratio_sampler_64(spark, d):
    """A tenth by all 64 low bits of a trace id, as a number without sign."""
    low = F.conv(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 17, 16), 16, 10).cast("decimal(20,0)")
    return events(spark, d).where(low < F.lit(str((1 << 64) // 10 + 1)).cast("decimal(20,0)")).select("event_id")


@R.add("trace_passthrough", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'tp' || event_id END AS traceparent FROM events")
def trace_passthrough(spark, d):
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    name = F.when(F.col("event_id") % 2 == 0, "traceparent").otherwise("other")
    headers = F.array(header("content-type", F.lit("json")), F.struct(name.alias("key"), F.concat(F.lit("tp"), F.col("event_id").cast("string")).alias("value")))
    kept = F.filter(headers, lambda h: h["key"].isin("traceparent", "tracestate"))
    return events(spark, d).select("event_id", F.get(kept, F.lit(0)).getField("value").alias("traceparent"))


# ---- joins ----


@R.add("join_inner_dim", "SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_extendedprice > p_retailprice * 1.05 * 20")
def join_inner_dim(spark, d):
    part = read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rows.join(dimension(part), "l_partkey").where(F.col("l_extendedprice") > F.col("p_retailprice") * 1.05 * 20).select("l_orderkey", "l_linenumber", "p_brand")


@R.add("join_inner_2dim_range", "SELECT event_id, region, from_minute FROM (SELECT *, 60 * hour(ts) + minute(ts) AS m FROM events) JOIN (VALUES ('click', 'north', 0, 600), ('view', 'south', 1200, 300), ('click', 'east', 540, 900)) r(event_type, region, from_minute, to_minute) USING (event_type) WHERE CASE WHEN from_minute < to_minute THEN m >= from_minute AND m < to_minute ELSE m >= from_minute OR m < to_minute END")
def join_inner_2dim_range(spark, d):
    rules = spark.createDataFrame([("click", "north", 0, 600), ("view", "south", 1200, 300), ("click", "east", 540, 900)], "event_type string, region string, from_minute int, to_minute int")
    return events(spark, d).join(dimension(rules), "event_type").where(in_window(minute_of_day(F.col("ts")), F.col("from_minute"), F.col("to_minute"))).select("event_id", "region", "from_minute")


@R.add("join_left_anti_kv", "SELECT event_id FROM vehicles WHERE event_id NOT IN (SELECT event_id FROM vehicles WHERE kafka_offset % 3 = 0)")
def join_left_anti_kv(spark, d):
    v = binding.vehicles(spark, d)
    return dedup.not_seen(v, v.where("kafka_offset % 3 = 0"), "event_id").select("event_id")


@R.add("join_semi_prune", "SELECT event_id, tunnel_id FROM vehicles WHERE tunnel_id IN (SELECT tunnel_id FROM profiles)")
def join_semi_prune(spark, d):
    return binding.vehicles(spark, d).join(dimension(domain.profiles(spark).select("tunnel_id")), "tunnel_id", "left_semi").select("event_id", "tunnel_id")


_SENSED = """s AS (SELECT event_id, (ARRAY['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] AS tunnel_id, event_id % 2 AS direction, event_id % 3 AS lane, epoch_ms(ts) AS t0, 40 + event_id % 60 AS speed FROM events),
 f AS (SELECT *, t0 AS ms_f FROM s), m AS (SELECT *, t0 + (90000000 / (speed * 50)) ::BIGINT + event_id % 90 - 45 AS ms_m FROM s WHERE event_id % 11 > 0),
 l AS (SELECT *, t0 + 2 * (90000000 / (speed * 50))::BIGINT AS ms_l FROM s)"""


def sensed(spark: SparkSession, d: str) -> DataFrame:
    """Three detections of each event's vehicle, half a tunnel (500 m) apart; a middle one is missing now and then."""
    i = F.col("event_id")
    s = events(spark, d).select(
        "event_id", F.element_at(F.array(*map(F.lit, binding.TUNNELS)), (F.col("user_id") % 6 + 1).cast("int")).alias("tunnel_id"), (i % 2).alias("direction"), (i % 3).alias("lane"),
        # the nearest millisecond, as the SQL has it
        F.floor((F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col("ts")) + 500) / 1000).alias("t0"), (i % 60 + 40).alias("speed"),
    )
    return s.withColumn("hop", F.bround(F.lit(90_000_000) / (F.col("speed") * 50)).cast("bigint"))


def lasts(s: DataFrame) -> DataFrame:
    return s.select("tunnel_id", "direction", "lane", F.col("event_id").alias("l"), (F.col("t0") + 2 * F.col("hop")).alias("ms_l"), F.col("speed").alias("speed_l"))


def middles(s: DataFrame) -> DataFrame:
    return s.where("event_id % 11 > 0").select("tunnel_id", "direction", "lane", F.col("event_id").alias("m"), (F.col("t0") + F.col("hop") + F.col("event_id") % 90 - 45).alias("ms_m"))


def firsts(s: DataFrame) -> DataFrame:
    return s.select("tunnel_id", "direction", "lane", F.col("event_id").alias("f"), F.col("t0").alias("ms_f"))


_PAIR = "l.tunnel_id = m.tunnel_id AND l.direction = m.direction AND l.lane = m.lane AND abs(ms_m - (ms_l - 500 / (l.speed / 3.6::DOUBLE) * 1000)) <= 250 + 500 / (l.speed / 3.6::DOUBLE) * 1000 * 0.03::DOUBLE"


@R.add("join_interval_pair", f"WITH {_SENSED} SELECT l.event_id AS l, m.event_id AS m FROM l JOIN m ON {_PAIR}")
def join_interval_pair(spark, d):
    s = sensed(spark, d)
    return pairing.pair_candidates(lasts(s), middles(s), 500.0).select("l", "m")


@R.add("join_triplet_midpoint", f"WITH {_SENSED} SELECT l.event_id AS l, m.event_id AS m, f.event_id AS f FROM l JOIN m ON {_PAIR} JOIN f ON f.tunnel_id = l.tunnel_id AND f.direction = l.direction AND f.lane = l.lane AND abs(ms_f - (2 * ms_m - ms_l)) <= 150")
def join_triplet_midpoint(spark, d):
    s = sensed(spark, d)
    return pairing.triplets(pairing.pair_candidates(lasts(s), middles(s), 500.0), firsts(s)).select("l", "m", "f")


@R.add("join_plate_compat", "WITH p AS (SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE 'P' || (event_id % 4) END AS plate, ts::DATE AS day FROM events) SELECT a.event_id AS a, b.event_id AS b FROM p a JOIN p b ON a.user_id = b.user_id AND a.day = b.day AND a.event_id < b.event_id WHERE a.plate = '' OR b.plate = '' OR a.plate = b.plate")
def join_plate_compat(spark, d):
    p = events(spark, d).select("event_id", "user_id", F.to_date("ts").alias("day"), F.when(F.col("event_id") % 5 == 0, "").otherwise(F.concat(F.lit("P"), (F.col("event_id") % 4).cast("string"))).alias("plate"))
    a, b = p.withColumnsRenamed({"event_id": "a", "plate": "pa"}), p.withColumnsRenamed({"event_id": "b", "plate": "pb"})
    return a.join(b, ["user_id", "day"]).where((F.col("a") < F.col("b")) & pairing.plates_agree(F.col("pa"), F.col("pb"))).select("a", "b")


@R.add("join_calib_neighbors", f"WITH {_SENSED}, v AS (SELECT m.tunnel_id, (ms_m - ms_f) / 1000.0::DOUBLE * (m.speed + f.speed) / 2 / 3.6::DOUBLE AS half FROM m JOIN f ON m.tunnel_id = f.tunnel_id AND m.direction = f.direction AND m.lane = f.lane WHERE ms_f < ms_m AND ms_f >= ms_m - 60000) SELECT tunnel_id, floor((ln(half) / ln(1.01::DOUBLE))::DECIMAL(18,9)::DOUBLE) AS bin, count(*) AS votes FROM v WHERE half BETWEEN 50 AND 12500 GROUP BY ALL")
def join_calib_neighbors(spark, d):
    s = sensed(spark, d)
    m = middles(s.withColumn("event_id", F.col("event_id"))).join(s.select(F.col("event_id").alias("m"), F.col("speed").alias("speed_m")), "m")
    f = firsts(s).join(s.select(F.col("event_id").alias("f"), F.col("speed").alias("speed_f")), "f")
    near = pairing.range_join(m, f, ["tunnel_id", "direction", "lane"], F.col("ms_m") - 60_000, F.col("ms_m") - 1, F.col("ms_f"), 60_000)
    half = (F.col("ms_m") - F.col("ms_f")) / F.lit(1000.0) * (F.col("speed_m") + F.col("speed_f")) / 2 / F.lit(3.6)
    votes = near.select("tunnel_id", half.alias("half")).where("half BETWEEN 50 AND 12500")
    exact = F.floor((F.log("half") / F.lit(math.log(1.01))).cast("decimal(18,9)")).cast("double")
    return votes.groupBy("tunnel_id", exact.alias("bin")).agg(F.count(F.lit(1)).alias("votes"))


_CALIB_MS = round(WINDOW_S * 1000)


@R.add("join_calib_window", f"WITH {_SENSED}, v AS (SELECT m.tunnel_id, (ms_m - ms_f) / 1000.0::DOUBLE * (m.speed + f.speed) / 2 / 3.6::DOUBLE AS half FROM m JOIN f ON m.tunnel_id = f.tunnel_id AND m.direction = f.direction AND m.lane = f.lane WHERE ms_f < ms_m AND ms_f >= ms_m - {_CALIB_MS}) SELECT tunnel_id, floor((ln(half) / ln(1.01::DOUBLE))::DECIMAL(18,9)::DOUBLE) AS bin, count(*) AS votes FROM v WHERE half BETWEEN 50 AND 12500 GROUP BY ALL")
def join_calib_window(spark, d):
    # within the time that the largest half spacing takes at 20 km/h, as in fusion
    s = sensed(spark, d)
    m = middles(s).join(s.select(F.col("event_id").alias("m"), F.col("speed").alias("speed_m")), "m")
    f = firsts(s).join(s.select(F.col("event_id").alias("f"), F.col("speed").alias("speed_f")), "f")
    near = pairing.range_join(m, f, ["tunnel_id", "direction", "lane"], F.col("ms_m") - _CALIB_MS, F.col("ms_m") - 1, F.col("ms_f"), _CALIB_MS)
    half = (F.col("ms_m") - F.col("ms_f")) / F.lit(1000.0) * (F.col("speed_m") + F.col("speed_f")) / 2 / F.lit(3.6)
    votes = near.select("tunnel_id", half.alias("half")).where("half BETWEEN 50 AND 12500")
    exact = F.floor((F.log("half") / F.lit(math.log(1.01))).cast("decimal(18,9)")).cast("double")
    return votes.groupBy("tunnel_id", exact.alias("bin")).agg(F.count(F.lit(1)).alias("votes"))


@R.add("join_map_lookup", "WITH v AS (SELECT event_id, unnest([event_id, event_id + 1, event_id + 2]) AS member FROM events WHERE event_id % 3 = 0) SELECT v.event_id, member, event_type FROM v JOIN events e ON e.event_id = member")
def join_map_lookup(spark, d):
    i = F.col("event_id")
    v = events(spark, d).where(i % 3 == 0).select("event_id", F.explode(F.array(i, i + 1, i + 2)).alias("member"))
    return v.join(events(spark, d).select(i.alias("member"), "event_type"), "member").select("event_id", "member", "event_type")


@R.add("join_by_field_outer", "SELECT coalesce(a.user_id, b.user_id) AS pod, coalesce(a.day, b.day)::VARCHAR AS day, clicks::DOUBLE AS clicks, errors::DOUBLE AS errors FROM (SELECT user_id, ts::DATE AS day, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY ALL) a FULL JOIN (SELECT user_id, ts::DATE AS day, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY ALL) b USING (user_id, day)")
def join_by_field_outer(spark, d):
    # of all users by day, where most have one of the two only
    e = events(spark, d).select(F.col("user_id").alias("pod"), F.to_date("ts").cast("string").alias("day"), "event_type")
    one = lambda kind, name: e.where(F.col("event_type") == kind).groupBy("pod", "day").agg(F.count(F.lit(1)).cast("double").alias(name))
    return one("click", "clicks").join(one("error", "errors"), ["pod", "day"], "full_outer")


@R.add("join_by_field_outer_all", "SELECT coalesce(a.user_id, b.user_id) AS pod, clicks::DOUBLE AS clicks, errors::DOUBLE AS errors FROM (SELECT user_id, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1) a FULL JOIN (SELECT user_id, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1) b USING (user_id)")
def join_by_field_outer_all(spark, d):
    # of all users
    e = events(spark, d)
    one = lambda kind, name: e.where(F.col("event_type") == kind).groupBy(F.col("user_id").alias("pod")).agg(F.count(F.lit(1)).cast("double").alias(name))
    return one("click", "clicks").join(one("error", "errors"), "pod", "full_outer")


# ---- aggregations ----

_S = "round(sum(speed_kmh), 4) AS speed_sum, count(speed_kmh) AS speed_count, min(speed_kmh) AS speed_min, max(speed_kmh) AS speed_max, round(sum(length_m), 4) AS length_sum"


def _flat(states: DataFrame, keys: list) -> DataFrame:
    return states.select(*keys, "vehicles", F.round("speed_avg.sum", 4).alias("speed_sum"), F.col("speed_avg.count").alias("speed_count"), "speed_min", "speed_max", F.round("length_avg.sum", 4).alias("length_sum"))


for _unit, _tag, _states_of in (("minute", "1m", minute_states), ("hour", "1h", hour_states)):

    @R.add(f"agg_rollup_{_tag}", f"SELECT date_trunc('{_unit}', ts_entry) AS {_unit}, tunnel_id, direction, classification, count(*) AS vehicles, {_S} FROM firsts GROUP BY 1, 2, 3, 4")
    def _rollup(spark, d, unit=_unit, states=_states_of):
        return _flat(states(spark, d), [unit, *rollup.KEYS])

    @R.add(f"agg_merge_{_tag}", f"SELECT tunnel_id, classification, count(*) AS vehicles, {_S} FROM firsts GROUP BY 1, 2")
    def _merge(spark, d, states=_states_of):
        keys = ["tunnel_id", "classification"]
        return _flat(rollup.merge(states(spark, d), keys), keys)


@R.add("agg_state_background_merge", f"SELECT date_trunc('hour', ts_entry) AS hour, tunnel_id, direction, classification, count(*) AS vehicles, {_S} FROM firsts GROUP BY 1, 2, 3, 4")
def agg_state_background_merge(spark, d):
    """States of two halves of the input, stored apart, then compacted."""
    v = dedup.first_seen(binding.vehicles(spark, d), "event_id", ["kafka_partition", "kafka_offset"])
    parts = rollup.rollup(v.where("kafka_offset % 2 = 0"), "hour").unionByName(rollup.rollup(v.where("kafka_offset % 2 = 1"), "hour"))
    keys = ["hour", *rollup.KEYS]
    return _flat(rollup.merge(parts, keys), keys)


@R.add("agg_replacing_latest", "SELECT tunnel_id, event_id, speed_kmh, kafka_offset FROM dedup")
def agg_replacing_latest(spark, d):
    return dedup.vehicles_dedup(binding.vehicles(spark, d)).select("tunnel_id", "event_id", "speed_kmh", "kafka_offset")


@R.add("agg_argmax_latest", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, arg_max(value, (ts, event_id)) AS last_value, max(ts) AS last_ts FROM events GROUP BY 1")
def agg_argmax_latest(spark, d):
    best = events(spark, d).groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("b"), F.max("ts").alias("last_ts"))
    return best.select("user_id", F.col("b.event_type").alias("last_type"), F.col("b.value").alias("last_value"), "last_ts")


@R.add("agg_argmax_then_count", "SELECT last_type, count(*) AS users FROM (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1) GROUP BY 1")
def agg_argmax_then_count(spark, d):
    return agg_argmax_latest(spark, d).groupBy("last_type").agg(F.count(F.lit(1)).alias("users"))


@R.add("agg_sumif_countif", "SELECT l_returnflag, sum(CASE WHEN l_discount > 0.05 THEN l_quantity END) AS qty, count(*) FILTER (l_tax < 0.03) AS low_tax FROM lineitem GROUP BY 1")
def agg_sumif(spark, d):
    return read(spark, d, "lineitem").groupBy("l_returnflag").agg(F.sum(F.when(F.col("l_discount") > 0.05, F.col("l_quantity"))).alias("qty"), F.count_if(F.col("l_tax") < 0.03).alias("low_tax"))


@R.add("agg_ratio_guarded", "SELECT user_id, count(*) FILTER (event_type = 'error') / greatest(count(*) FILTER (event_type = 'click'), 1) AS share FROM events GROUP BY 1")
def agg_ratio_guarded(spark, d):
    of = lambda t: F.count_if(F.col("event_type") == t)
    return events(spark, d).groupBy("user_id").agg(ratio(of("error"), of("click")).alias("share"))


@R.add("agg_weighted_avg", "SELECT l_returnflag, round((sum(l_quantity * l_extendedprice) / greatest(sum(l_quantity), 1))::DOUBLE, 3) AS price FROM lineitem GROUP BY 1")
def agg_weighted_avg(spark, d):
    q, p = F.col("l_quantity").cast("double"), F.col("l_extendedprice").cast("double")
    return read(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(q * p) / F.greatest(F.sum(q), F.lit(1.0)), 3).alias("price"))


@R.add("agg_uniq_exact", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def agg_uniq_exact(spark, d):
    return events(spark, d).groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))


@R.add("agg_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def agg_distinct(spark, d):
    return events(spark, d).select("user_id", "event_type").distinct()


@R.add("agg_quantile", "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.85), 6) AS p85, round(quantile_cont(value, 0.95), 6) AS p95 FROM events GROUP BY 1")
def agg_quantile(spark, d):
    return events(spark, d).groupBy("event_type").agg(*[F.round(F.percentile("value", q), 6).alias(f"p{round(100 * q)}") for q in rollup.QUANTILES])


@R.add("agg_quantile_kll", "SELECT event_type, count(value) AS n, true AS p50_near, true AS p85_near, true AS p95_near FROM events GROUP BY 1")
def agg_quantile_kll(spark, d):
    """Sketches of two parts, merged; each answer lies between the exact values at its rank less and plus the error."""
    e = events(spark, d)
    parts = quantiles.sketches(e.withColumn("part", F.col("event_id") % 2), ["event_type", "part"], "value")
    found = quantiles.quantiles_of(quantiles.merged(parts, ["event_type"]), ["event_type"], rollup.QUANTILES)
    error = 2 * quantiles.rank_error()
    exact = e.join(F.broadcast(found.select("event_type", "p50", "p85", "p95")), "event_type").groupBy("event_type").agg(
        F.count("value").alias("n"), *[F.avg((F.col("value") < F.col(p)).cast("int")).alias(f"{p}_low") for p in ("p50", "p85", "p95")], *[F.avg((F.col("value") <= F.col(p)).cast("int")).alias(f"{p}_high") for p in ("p50", "p85", "p95")]
    )
    near = lambda p, q: ((F.col(f"{p}_low") <= q + error) & (F.col(f"{p}_high") >= q - error)).alias(f"{p}_near")
    return exact.select("event_type", "n", near("p50", 0.5), near("p85", 0.85), near("p95", 0.95))


@R.add(
    "agg_totals_rate",
    """WITH s AS (SELECT *, lag(value) OVER w AS last, lag(ts) OVER w AS since FROM metrics WINDOW w AS (PARTITION BY job, pod ORDER BY ts)),
 r AS (SELECT job, ts, CASE WHEN value >= last THEN value - last ELSE value END AS rise, date_sub('second', since, ts) AS seconds FROM s WHERE last IS NOT NULL)
 SELECT job, ts, sum(rise) AS total, round(sum(rise / seconds), 9) AS rate FROM r GROUP BY 1, 2""",
)
def agg_totals_rate(spark, d):
    # each worker's counters against its last snapshot, restarts as resets, added up over workers
    rises = counters.increases(binding.metrics(spark, d), ["job", "pod"], "ts", "value")
    return counters.total_rate(rises, ["job", "ts"]).select("job", "ts", "total", F.round("rate", 9).alias("rate"))


@R.add(
    "fn_shard",
    """WITH crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS of_byte FROM range(256) r(i)),
 k AS (SELECT DISTINCT user_id, hex(encode('tunnel-' || user_id)) AS h, (SELECT of_byte FROM crc) AS of_byte FROM events),
 c AS (SELECT user_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)), lambda c, x: xor(c >> 8, of_byte[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM k)
 SELECT crc % 16 AS shard, count(*) AS tunnels FROM c GROUP BY 1""",
)
def fn_shard(spark, d):
    """Which of 16 workers owns a key: crc32 of the key, modulo their number."""
    keys = events(spark, d).select("user_id").distinct()
    return keys.groupBy((F.crc32(F.concat(F.lit("tunnel-"), F.col("user_id").cast("string")).cast("binary")) % 16).alias("shard")).agg(F.count(F.lit(1)).alias("tunnels"))


_G = rollup.gamma(0.01)


@R.add(
    "agg_quantiles_ddsketch",
    f"WITH s AS (SELECT event_type, ceil(ln(value) / {math.log(_G)!r}::DOUBLE)::INT AS b, count(*) AS n FROM events GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY b) AS upto, sum(n) OVER (PARTITION BY event_type) AS whole FROM s) SELECT event_type, "
    + ", ".join(f"round(min(CASE WHEN upto >= greatest(1, ceil({q} * whole)) THEN 2 * pow({_G!r}::DOUBLE, b) / ({_G!r}::DOUBLE + 1) END), 6) AS p{round(100 * q)}" for q in rollup.QUANTILES)
    + " FROM c GROUP BY 1",
)
def agg_quantiles_ddsketch(spark, d):
    """Two sketches (even and odd events), merged, then read."""
    e = events(spark, d)
    parts = [rollup.sketch_rows(e.where(F.col("event_id") % 2 == k), ["event_type"], F.col("value"), 0.01) for k in (0, 1)]
    merged = rollup.merge_sketches(parts[0].unionByName(parts[1]), ["event_type"])
    q = rollup.sketch_quantiles(merged, ["event_type"], alpha=0.01)
    return q.select("event_type", *[F.round(c, 6).alias(c) for c in q.columns[1:]])


@R.add("agg_any", "SELECT n_regionkey, min(n_name) AS some FROM nation GROUP BY 1")
def agg_any(spark, d):
    return read(spark, d, "nation").groupBy("n_regionkey").agg(F.min("n_name").alias("some"))


@R.add("agg_avg_min_max_count", "SELECT event_type, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high, count(*) AS n FROM events GROUP BY 1")
def agg_plain(spark, d):
    return events(spark, d).groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"), F.count(F.lit(1)).alias("n"))


@R.add("agg_having_alias", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id HAVING arg_max(events.event_type, (ts, event_id)) <> 'view'")
def agg_having_alias(spark, d):
    return events(spark, d).groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type")).where("event_type <> 'view'")


@R.add("agg_empty_guard", "SELECT CASE WHEN count(*) = 0 THEN NULL ELSE max(event_id) END AS latest FROM events WHERE ts > TIMESTAMP '2030-01-01'")
def agg_empty_guard(spark, d):
    rows = events(spark, d).where(F.col("ts") > F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00")))
    return rows.agg(F.when(F.count(F.lit(1)) > 0, F.max("event_id")).alias("latest"))


@R.add("agg_group_array", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def agg_group_array(spark, d):
    return read(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"))


@R.add("agg_map_sum", "SELECT tunnel_id, sum(n_start + n_end)::BIGINT AS total FROM traffic GROUP BY 1")
def agg_map_sum(spark, d):
    return binding.traffic(spark, d).groupBy("tunnel_id").agg(F.sum(map_total(F.col("start_to_end")) + map_total(F.col("end_to_start"))).alias("total"))


@R.add("agg_map_get", "SELECT (['TR-AVRASYA','TR-BOLU','TR-ZIGANA','TR-OVIT','TR-ILGAZ','T000005'])[user_id % 6 + 1] AS tunnel_id, sum(CASE WHEN event_id % 2 > 0 THEN 0 WHEN event_id % 10 = 0 THEN event_id % 3 WHEN event_id % 10 = 8 THEN event_id % 4 + 1 ELSE 0 END)::BIGINT AS cars, sum(CASE WHEN event_id % 10 = 0 THEN event_id % 3 ELSE 0 END)::BIGINT AS back FROM events GROUP BY 1")
def agg_map_get(spark, d):
    # a class looked up wherever it stands in the map: in both directions, and none where it is not there
    got = lambda side, kind: F.coalesce(F.try_element_at(side, F.lit(kind)), F.lit(0))
    both = got("start_to_end", "OTOMOBIL") + got("start_to_end", "OZEL_AMACLI_TASIT")
    return binding.traffic(spark, d).groupBy("tunnel_id").agg(F.sum(both).alias("cars"), F.sum(got("end_to_start", "OTOMOBIL")).alias("back"))


@R.add("agg_traffic_window", "WITH b AS (SELECT tunnel_id, ts_entry::DATE AS day, direction, classification, count(*) AS n FROM firsts GROUP BY ALL) SELECT day::VARCHAR AS day, tunnel_id, sum(n)::BIGINT AS vehicles, string_agg(direction || '/' || classification || '=' || n, ',' ORDER BY direction, classification) AS counts FROM b GROUP BY ALL")
def agg_traffic_window(spark, d):
    v = dedup.first_seen(binding.vehicles(spark, d), "event_id", ["kafka_partition", "kafka_offset"])
    by = v.groupBy(F.to_date("ts_entry").cast("string").alias("day"), "tunnel_id", "direction", "classification").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct("direction", "classification", "n")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.concat(e["direction"], F.lit("/"), e["classification"], F.lit("="), e["n"].cast("string"))), ",")
    return by.groupBy("day", "tunnel_id").agg(F.sum("n").alias("vehicles"), joined.alias("counts"))


_VOTE = "ln(least(greatest(c, 0.5), 0.999)::DOUBLE * 8 / (1 - least(greatest(c, 0.5), 0.999)::DOUBLE))"
_VOTES = f"v AS (SELECT event_id // 3 AS vehicle, event_id AS i, (['KAMYON', 'OTOBUS', 'OTOMOBIL', 'BILINMEYEN'])[(event_id * 7) % 4 + 1] AS k, 0.4::DOUBLE + (event_id % 60) / 100.0::DOUBLE AS c FROM events), s AS (SELECT vehicle, k, round(sum({_VOTE}), 9) AS score, min(i) AS i, count(*) AS n FROM v WHERE k <> 'BILINMEYEN' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY vehicle ORDER BY score DESC, i) AS r, lead(score) OVER (PARTITION BY vehicle ORDER BY score DESC, i) AS next FROM s), w AS (SELECT vehicle, k AS winner, score, CASE WHEN next IS NULL THEN score ELSE score - next END AS margin FROM r WHERE r = 1), a AS (SELECT vehicle, count(*) AS n, min(c) AS c FROM v GROUP BY 1)"


def votes(spark: SparkSession, d: str) -> DataFrame:
    """Groups of detections with the class each saw and how sure it was; the winner by log-odds."""
    i = F.col("event_id")
    v = events(spark, d).select(F.floor(i / 3).alias("vehicle"), i.alias("i"), F.element_at(F.array(*map(F.lit, ("KAMYON", "OTOBUS", "OTOMOBIL", domain.UNKNOWN))), (i * 7 % 4 + 1).cast("int")).alias("k"), (F.lit(0.4) + i % 60 / F.lit(100.0)).alias("c"))
    c = F.least(F.greatest("c", F.lit(0.5)), F.lit(0.999))
    s = v.where(F.col("k") != domain.UNKNOWN).groupBy("vehicle", "k").agg(F.round(F.sum(F.log(c * 8 / (1 - c))), 9).alias("score"), F.min("i").alias("i"))
    # the best two by score, earlier detections first on ties
    ranked = s.groupBy("vehicle").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "i", "k"))).alias("r"))
    best, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    won = ranked.select("vehicle", best["k"].alias("winner"), (-best["minus"]).alias("score"), F.when(second.isNull(), -best["minus"]).otherwise(second["minus"] - best["minus"]).alias("margin"))
    all_ = v.groupBy("vehicle").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c"), F.collect_list("k").alias("ks"))
    return all_.join(won, "vehicle", "left")


@R.add("agg_vote_logodds", f"WITH {_VOTES} SELECT vehicle, coalesce(winner, 'BILINMEYEN') AS winner, round(coalesce(margin, 0), 6) AS margin FROM a LEFT JOIN w USING (vehicle)")
def agg_vote_logodds(spark, d):
    return votes(spark, d).select("vehicle", F.coalesce("winner", F.lit(domain.UNKNOWN)).alias("winner"), F.round(F.coalesce("margin", F.lit(0.0)), 6).alias("margin"))


@R.add("agg_confidence", f"WITH {_VOTES} SELECT vehicle, round(CASE WHEN n > 1 THEN 1 / (1 + exp(-least(coalesce(margin, 0), 30))) ELSE least(c, 0.999) END, 6) AS confidence FROM a LEFT JOIN w USING (vehicle)")
def agg_confidence(spark, d):
    margin = F.coalesce("margin", F.lit(0.0))
    sure = F.when(F.col("n") > 1, 1 / (1 + F.exp(-F.least(margin, F.lit(30.0))))).otherwise(F.least("c", F.lit(0.999)))
    return votes(spark, d).select("vehicle", F.round(sure, 6).alias("confidence"))


@R.add("agg_agreement", f"WITH {_VOTES} SELECT vehicle, count(*) FILTER (k = coalesce(winner, 'BILINMEYEN')) / count(*) AS agreement FROM v LEFT JOIN w USING (vehicle) GROUP BY 1")
def agg_agreement(spark, d):
    won = F.coalesce("winner", F.lit(domain.UNKNOWN))
    return votes(spark, d).select("vehicle", (F.size(F.filter("ks", lambda k: k == won)) / F.col("n")).alias("agreement"))


@R.add("agg_vote_histogram", "WITH b AS (SELECT user_id % 6 AS tunnel, floor(value / 10)::INT AS bin, count(*) AS n FROM events GROUP BY ALL), w AS (SELECT tunnel, bin, sum(n) OVER (PARTITION BY tunnel ORDER BY bin RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS votes FROM b) SELECT tunnel, max(votes)::BIGINT AS votes, arg_max(bin, (votes, -bin)) AS peak FROM w GROUP BY 1")
def agg_vote_histogram(spark, d):
    b = events(spark, d).groupBy((F.col("user_id") % 6).alias("tunnel"), F.floor(F.col("value") / 10).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = b.withColumn("votes", F.sum("n").over(W.partitionBy("tunnel").orderBy("bin").rangeBetween(-3, 3)))
    return w.groupBy("tunnel").agg(F.max("votes").alias("votes"), F.max_by("bin", F.struct("votes", -F.col("bin"))).alias("peak"))


_BOUNDS = (10.0, 50.0, 100.0, 250.0, 500.0)


@R.add("agg_histogram_bucket", "SELECT event_type, " + ", ".join(f"count(*) FILTER (value <= {b}) AS le_{round(b)}" for b in _BOUNDS) + ", count(*) AS le_inf, round(sum(value), 4) AS total FROM events GROUP BY 1")
def agg_histogram_bucket(spark, d):
    return events(spark, d).groupBy("event_type").agg(*[F.count_if(F.col("value") <= b).alias(f"le_{round(b)}") for b in _BOUNDS], F.count(F.lit(1)).alias("le_inf"), F.round(F.sum("value"), 4).alias("total"))


@R.add("agg_seq_gap", "SELECT sensor_id, boot_id, count(*) AS received, count(DISTINCT seq) AS accepted, count(*) - count(DISTINCT seq) AS duplicates, max(seq) - min(seq) + 1 - count(DISTINCT seq) AS lost FROM detections GROUP BY 1, 2")
def agg_seq_gap(spark, d):
    return dedup.sequence_gaps(binding.detections(spark, d))


@R.add("agg_eval_quality", "WITH v AS (SELECT event_id // 3 AS vehicle, CASE WHEN event_id % 17 = 0 THEN event_id ELSE event_id // 3 END AS truth FROM events), g AS (SELECT vehicle, count(*) AS n, count(DISTINCT truth) AS truths FROM v GROUP BY 1) SELECT count(*) AS vehicles, count(*) FILTER (truths = 1 AND n = 3) / count(*) AS perfect, count(*) FILTER (truths > 1) / count(*) AS mixed FROM g")
def agg_eval_quality(spark, d):
    i = F.col("event_id")
    v = events(spark, d).select(F.floor(i / 3).alias("vehicle"), F.when(i % 17 == 0, i).otherwise(F.floor(i / 3)).alias("truth"))
    g = v.groupBy("vehicle").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("truth").alias("truths"))
    n = F.count(F.lit(1))
    return g.agg(n.alias("vehicles"), (F.count_if((F.col("truths") == 1) & (F.col("n") == 3)) / n).alias("perfect"), (F.count_if(F.col("truths") > 1) / n).alias("mixed"))


# ---- order, top-k, sets ----


@R.add("topk_order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def topk_order_limit(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


@R.add("topk_limit_by", "SELECT event_id, kafka_offset, speed_kmh FROM firsts")
def topk_limit_by(spark, d):
    return dedup.first_per_key(binding.vehicles(spark, d), "event_id", ["kafka_partition", "kafka_offset"]).select("event_id", "kafka_offset", "speed_kmh")


@R.add("sort_multi", "SELECT tunnel_id, vehicle_type, from_minute FROM rules ORDER BY tunnel_id, vehicle_type, from_minute")
def sort_multi(spark, d):
    return domain.rules(spark).select("tunnel_id", "vehicle_type", "from_minute").orderBy("tunnel_id", "vehicle_type", "from_minute")


@R.add("sort_time", "SELECT date_trunc('hour', ts) AS time, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def sort_time(spark, d):
    return events(spark, d).groupBy(bucket("hour", "ts").alias("time")).agg(F.count(F.lit(1)).alias("n")).orderBy("time")


@R.add("topk_prom", "SELECT day, user_id, n FROM (SELECT ts::DATE::VARCHAR AS day, user_id, count(*) AS n, row_number() OVER (PARTITION BY ts::DATE ORDER BY count(*) DESC, user_id) AS r FROM events GROUP BY ts::DATE, user_id) WHERE r <= 10")
def topk_prom(spark, d):
    per = events(spark, d).groupBy(F.to_date("ts").cast("string").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return dedup.first_per_key(per, "day", [F.desc("n"), "user_id"], 10)


@R.add("set_union_all", "SELECT 'customer' AS kind, c_acctbal AS balance, 0 AS orders FROM customer UNION ALL SELECT 'supplier', s_acctbal, 1 FROM supplier")
def set_union_all(spark, d):
    c = read(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"), F.lit(0).alias("orders"))
    return c.unionByName(read(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"), F.lit(1).alias("orders")))


@R.add("set_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union_distinct(spark, d):
    return read(spark, d, "customer").select(F.col("c_nationkey").alias("nation")).union(read(spark, d, "supplier").select("s_nationkey")).distinct()


@R.add("set_alert_union", "SELECT tunnel_id, count(*) AS n FROM (SELECT tunnel_id FROM dedup WHERE sensors >= 2 AND speed_kmh > 100 UNION ALL SELECT tunnel_id FROM dedup WHERE classification = 'KAMYON') GROUP BY 1")
def set_alert_union(spark, d):
    v = dedup.vehicles_dedup(binding.vehicles(spark, d))
    both = v.where("sensors >= 2 AND speed_kmh > 100").select("tunnel_id").unionByName(v.where("classification = 'KAMYON'").select("tunnel_id"))
    return both.groupBy("tunnel_id").agg(F.count(F.lit(1)).alias("n"))


# ---- scalar functions ----


@R.add("fn_datetime", "SELECT event_id, date_trunc('minute', ts) AS m, date_trunc('hour', ts) AS h, date_trunc('month', ts) AS mo, hour(ts + INTERVAL 3 HOUR)::INT AS lh, minute(ts)::INT AS mi, (ts + INTERVAL 3 HOUR)::DATE::VARCHAR AS ld FROM events")
def fn_datetime(spark, d):
    return events(spark, d).select("event_id", bucket("minute", "ts").alias("m"), bucket("hour", "ts").alias("h"), bucket("month", "ts").alias("mo"), F.hour(local_time("ts")).alias("lh"), F.minute("ts").alias("mi"), F.to_date(local_time("ts")).cast("string").alias("ld"))


@R.add("fn_string", "SELECT n_nationkey, lpad(n_nationkey::VARCHAR, 5, '0') AS padded, substring(n_name, 1, 3) AS head, n_name || '-' || n_regionkey AS id, array_to_string(string_split(n_name, 'A'), '.') AS joined FROM nation")
def fn_string(spark, d):
    name = F.col("n_name")
    return read(spark, d, "nation").select("n_nationkey", F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("padded"), F.substring(name, 1, 3).alias("head"), F.concat(name, F.lit("-"), F.col("n_regionkey").cast("string")).alias("id"), F.array_join(F.split(name, "A", -1), ".").alias("joined"))


@R.add("fn_math", "SELECT event_id, event_id // 60 AS q, event_id % 60 AS r, greatest(event_id, 500) AS g, round(exp(value / 100), 6) AS e, round(sqrt(value), 6) AS s, round(value / 3.6::DOUBLE, 6) AS ms, round(ln(1 + value), 6) AS l FROM events")
def fn_math(spark, d):
    i, v = F.col("event_id"), F.col("value")
    return events(spark, d).select("event_id", F.expr("event_id div 60").alias("q"), (i % 60).alias("r"), F.greatest(i, F.lit(500)).alias("g"), F.round(F.exp(v / 100), 6).alias("e"), F.round(F.sqrt(v), 6).alias("s"), F.round(v / F.lit(3.6), 6).alias("ms"), F.round(F.log1p(v), 6).alias("l"))


@R.add("fn_conditional", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS seen, value BETWEEN 10 AND 20 AS low FROM events")
def fn_conditional(spark, d):
    return events(spark, d).select("event_id", F.when(F.col("event_type").isin("click", "view"), 1).otherwise(0).alias("seen"), F.col("value").between(10, 20).alias("low"))


@R.add("fn_array", "SELECT event_id, len(x) AS n, list_max(x) AS top, list_sum(x)::BIGINT AS total, x[-1] AS last, array_to_string(list_filter(['start', 'middle', 'end'], lambda p: p <> (['start', 'middle', 'end'])[event_id % 3 + 1]), ',') AS missing FROM (SELECT event_id, [event_id, event_id % 7, event_id % 11] AS x FROM events)")
def fn_array(spark, d):
    i = F.col("event_id")
    x = F.array(i, i % 7, i % 11)
    seen = F.element_at(F.array(*map(F.lit, domain.POSITIONS)), (i % 3 + 1).cast("int"))
    missing = F.filter(F.array(*map(F.lit, domain.POSITIONS)), lambda p: p != seen)
    return events(spark, d).select("event_id", F.size(x).alias("n"), F.array_max(x).alias("top"), F.aggregate(x, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"), F.element_at(x, -1).alias("last"), F.array_join(missing, ",").alias("missing"))


@R.add("fn_json", "SELECT event_id, (props->>'k')::BIGINT + 1 AS k1, props->>'none' AS none FROM events")
def fn_json(spark, d):
    v = F.try_parse_json("props")
    return events(spark, d).select("event_id", (F.try_variant_get(v, "$.k", "bigint") + 1).alias("k1"), F.try_variant_get(v, "$.none", "string").alias("none"))


@R.add("fn_base64_utf8", "SELECT n_nationkey, to_base64(n_name::BLOB) AS encoded, n_name AS decoded, NULL::VARCHAR AS strict FROM nation")
def fn_base64(spark, d):
    e = F.base64(F.col("n_name").cast("binary"))
    return read(spark, d, "nation").select("n_nationkey", e.alias("encoded"), strict_base64(e).cast("string").alias("decoded"), strict_base64(F.concat(e, F.lit("!"))).cast("string").alias("strict"))


@R.add("fn_hash", "SELECT n_name, sha256(n_name) AS sha, md5(n_name) AS m FROM nation")
def fn_hash(spark, d):
    b = F.col("n_name").cast("binary")
    return read(spark, d, "nation").select("n_name", F.sha2(b, 256).alias("sha"), F.md5(b).alias("m"))


@R.add("fn_plate", "SELECT code, CASE WHEN code < 260000 THEN chr((65 + code // 10000)::INT) || ' ' || lpad((code % 10000)::VARCHAR, 4, '0') WHEN code - 260000 < 6760000 THEN chr((65 + (code - 260000) // 260000)::INT) || chr((65 + ((code - 260000) // 10000) % 26)::INT) || ' ' || lpad(((code - 260000) % 10000)::VARCHAR, 4, '0') ELSE chr((65 + ((code - 7020000) // 100) // 676)::INT) || chr((65 + (((code - 7020000) // 100) // 26) % 26)::INT) || chr((65 + ((code - 7020000) // 100) % 26)::INT) || ' ' || lpad(((code - 7020000) % 100)::VARCHAR, 2, '0') END AS plate FROM (SELECT (event_id * 7919) % 8777600 AS code FROM events)")
def fn_plate(spark, d):
    return events(spark, d).select((F.col("event_id") * 7919 % 8_777_600).alias("code")).select("code", plate_body(F.col("code")).alias("plate"))


@R.add("fn_time_of_day", "SELECT DISTINCT m, lpad((m // 60)::VARCHAR, 2, '0') || ':' || lpad((m % 60)::VARCHAR, 2, '0') AS at FROM (SELECT (event_id % 1441)::INT AS m FROM events)")
def fn_time_of_day(spark, d):
    return events(spark, d).select((F.col("event_id") % 1441).cast("int").alias("m")).distinct().select("m", hhmm(F.col("m")).alias("at"))


@R.add("alert_sql_threshold", "SELECT day, n, n > 20 AS firing FROM (SELECT (ts_entry + INTERVAL 3 HOUR)::DATE::VARCHAR AS day, count(*) AS n FROM dedup JOIN profiles USING (tunnel_id) WHERE sensors >= 2 AND speed_kmh > speed_limit_kmh::DOUBLE * 1.05::DOUBLE GROUP BY 1)")
def alert_sql_threshold(spark, d):
    per = speeding(spark, d).groupBy(F.col("local_day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("firing", F.col("n") > 20)


@R.add("sink_prune_exchange", "SELECT tunnel_id, count(*) AS kept FROM vehicles WHERE tunnel_id IN (SELECT tunnel_id FROM profiles) GROUP BY 1")
def sink_prune_exchange(spark, d):
    from adit.operators.lifecycle import pruned

    return pruned(binding.vehicles(spark, d), domain.profiles(spark)).groupBy("tunnel_id").agg(F.count(F.lit(1)).alias("kept"))


