"""Stored states and versioned tables, versions without sorting, counters and sketches."""

import random

import pytest
from pyspark.sql import functions as F

from adit.operators import counters, dedup, quantiles, rollup, states
from adit.operators.lifecycle import pruned_store
from adit.operators.versions import Conflict, Store
from adit.plans import dashboards
from adit.sources import binding, domain

SF = "/root/testdata/sf0.001"


def flat(df, unit):
    rows = rollup.finalised(df, unit).collect()
    return sorted(tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in rows)


def test_stored_states_are_those_of_all_events(spark, tmp_path):
    vehicles = binding.vehicles(spark, SF)
    store = Store(spark, str(tmp_path))
    parts = [vehicles.where(f"pmod(xxhash64(kafka_offset), 3) = {k}") for k in range(3)]  # replays fall into other parts
    for k, part in enumerate(parts):
        assert states.take_in(store, part, f"part {k}") == k + 1
    assert states.take_in(store, parts[0], "part 0") == 3  # taken in already
    firsts = dedup.first_seen(vehicles, "event_id", states.ORDER, states.COLUMNS)
    n = firsts.count()
    for unit in ("minute", "hour"):
        stored = states.read(store, unit)
        assert stored.agg(F.sum("vehicles")).first()[0] == n
        assert stored.select(unit, *rollup.KEYS).distinct().count() == stored.count()  # merged, one state a key
        keys = [unit, *rollup.KEYS]
        counts = lambda df: sorted(map(str, df.select(*keys, "vehicles").collect()))
        assert counts(stored) == counts(rollup.rollup(firsts, unit))
    since = states.read(store, "hour", "2024-01-10", "2024-01-11")
    assert {str(r["hour"])[:10] for r in since.select("hour").collect()} == {"2024-01-10", "2024-01-11"}


def test_a_late_event_changes_one_day(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    vehicles = binding.vehicles(spark, SF)
    states.take_in(store, vehicles, "all")
    before = store.current()[1]
    late = vehicles.where("kafka_offset = 5").withColumn("event_id", F.lit("late"))
    states.take_in(store, late, "late")
    after = store.current()[1]
    day = str(late.first()["ts_entry"])[:10]
    for part in ("minute", "hour", "ids"):
        assert {d for d in after[part] if after[part][d] != before[part].get(d)} == {day}
    assert states.read(store, "hour").agg(F.sum("vehicles")).first()[0] == states.read(store, "ids").count() == 1001


def test_readers_see_a_commit_whole_or_not_at_all(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = spark.createDataFrame([("TR-BOLU", "2024-01-01 10:00:00"), ("GONE", "2024-01-01 11:00:00"), ("GONE", "2024-01-02 09:00:00")], "tunnel_id string, ts string").withColumn("ts", F.to_timestamp_ntz("ts"))
    schema = "tunnel_id string, ts timestamp_ntz"
    store.commit({"facts": rows.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))})
    old = store.read("facts", schema)  # planned before, read after the exchange
    assert pruned_store(store, "facts", schema, domain.profiles(spark), "ts") == 2
    assert old.count() == 3 and [r["tunnel_id"] for r in store.read("facts", schema).collect()] == ["TR-BOLU"]
    with pytest.raises(Conflict):  # made from what is no longer the newest
        store.commit({"facts": rows.withColumn("day", F.lit("2024-01-03"))}, after=1)
    draft = Store(spark, str(tmp_path))
    draft.current = lambda: (1, *store._load(1))  # a writer that has not seen the second commit
    with pytest.raises(Conflict):
        draft.commit({"facts": rows.withColumn("day", F.lit("2024-01-03"))})
    assert store.current()[0] == 2
    store.vacuum(keep=1)
    assert store.read("facts", schema).count() == 1 and store._numbers() == [2]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["Q08_vehicles", "Q12_by_type", "Q16_speed_distribution", "Q17_consensus_quality", "Q25_speeding", "Q28_tunnels_with_alert", "Q30_restricted_list", "Q35_types_per_hour", "Q42_restricted_today", "V1_vehicles_dedup", "V2_minute_stats", "V4_speeding_alerts"])
def test_panels_neither_sort_versions_nor_read_all_days(spark, name):
    plan = plan_of(dashboards.R.queries[name](spark, SF))
    if name[:3] not in ("Q16", "Q28"):  # percentile; distinct count
        assert "SortAggregate" not in plan
    if name[:3] in ("Q16", "Q17", "Q25", "Q28", "Q30", "Q42"):
        assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan  # the days reach the scan


@pytest.mark.parametrize("first", [True, False])
def test_one_of_each_is_that_of_a_plain_search(spark, first):
    rng = random.Random(7)
    rows = [(f"k{rng.randrange(150)}" if rng.random() < 0.9 else None, rng.randrange(6) if rng.random() < 0.9 else None, k, rng.random()) for k in range(400)]
    df = spark.createDataFrame([*rows, *rows[:20]], "key string, a int, b int, x double")  # rows that repeat whole, too
    found = [tuple(r) for r in dedup._one_of_each(df.where("key IS NOT NULL AND a IS NOT NULL"), ["key"], ["a", "b"], first).collect()]
    full = {}
    for r in rows:
        if r[0] is not None and r[1] is not None and (r[0] not in full or ((r[1], r[2]) < full[r[0]][1:3]) == first):
            full[r[0]] = r
    assert sorted(found) == sorted(full.values())


def test_rates_of_parts_are_those_of_the_whole(spark):
    rng, rows, now = random.Random(2), [], {}
    for k in range(60):
        for worker in "ab":
            now[worker] = 0.0 if rng.random() < 0.1 else now.get(worker, 0.0) + rng.randrange(9)
            rows.append((worker, f"2024-01-01 {k // 60:02}:{k % 60:02}:00", now[worker]))
    df = spark.createDataFrame(rows, "worker string, at string, value double").withColumn("at", F.to_timestamp_ntz("at")).cache()
    whole = counters.increases(df, ["worker"], "at", "value")
    cut = "at < timestamp_ntz'2024-01-01 00:23:00'"
    early, late = df.where(cut), df.where(f"NOT ({cut})")
    last = counters.last_snapshots(early, ["worker"], "at", "value")
    parts = counters.increases(early, ["worker"], "at", "value").unionByName(counters.increases(late, ["worker"], "at", "value", last))
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    plain, before = 0.0, {}
    for worker, _, value in rows:
        if worker in before:
            plain += value - before[worker] if value >= before[worker] else value
        before[worker] = value
    assert whole.agg(F.sum("rise")).first()[0] == plain
    assert counters.last_snapshots(late, ["worker"], "at", "value", last).count() == 2


def test_merged_sketches_stay_small_and_near(spark):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.pow(F.rand(5), 3).alias("x"), (F.col("id") % 7).alias("part"))
    parts = quantiles.sketches(rows, ["k", "part"], "x")
    whole = quantiles.merged(parts, ["k"])
    assert whole.agg(F.max(F.length("sketch"))).first()[0] < 20_000  # bytes, of 20,000 values
    found = quantiles.quantiles_of(whole, ["k"], (0.01, 0.5, 0.95)).collect()
    values = {k: sorted(r["x"] for r in rows.where(f"k = {k}").collect()) for k in range(3)}
    for r in found:
        assert r["n"] == 20_000
        for q, name in ((0.01, "p1"), (0.5, "p50"), (0.95, "p95")):
            rank = sum(x <= r[name] for x in values[r["k"]]) / 20_000
            assert abs(rank - q) <= 2 * quantiles.rank_error()
    nothing = quantiles.quantiles_of(quantiles.sketches(rows.withColumn("x", F.lit(None).cast("double")), ["k"], "x"), ["k"], (0.5,)).collect()
    assert all(r["n"] == 0 and r["p50"] is None for r in nothing)
