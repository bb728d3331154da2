"""Fusion of streams and state by key: streams against tables, for several ways to cut the input."""

import random
import time

import pytest
import traffic
from pyspark.sql import functions as F
from test_fusion import START, messages, plain_sequence, sensed

from adit.operators.dedup import by_sequence
from adit.sources import domain
from adit.streaming import fusion, online, sensors

MESSAGE = "arrival long, message_id string, sensor_id string, boot_id string, seq long"


@pytest.fixture(scope="module", autouse=True)
def store(spark):
    spark.conf.set(*sensors.STORE)
    yield
    spark.conf.unset(sensors.STORE[0])


def cut(rows, cuts):
    """Rows (in order) in parts of random size."""
    rng = random.Random(cuts)
    ends = sorted(rng.sample(range(1, len(rows)), cuts))
    return [rows[a:b] for a, b in zip([0, *ends], [*ends, len(rows)], strict=True)]


@pytest.mark.parametrize("cuts", [1, 3, 40])
def test_a_ring_of_bits_knows_what_a_set_of_all_numbers_knows(cuts):
    import numpy as np

    sent = [m for m in messages(3000, cuts) if m[0] == "p"]
    for window in (512, 64, 5):
        seen, taken = sensors.Sequence(window), []
        for part in cut(sent, cuts):
            taken += seen.take([b for _, b, _ in part], np.array([n for *_, n in part], np.int64)).tolist()
            seen = sensors.Sequence(window, seen.boot, seen.top, int.from_bytes(seen.ring.to_bytes(-(-window // 8), "big"), "big"))
        assert [k for k, t in enumerate(taken) if t] == plain_sequence(sent, window)


def test_a_stream_counts_messages_once_as_the_table_does(spark, tmp_path):
    sent = messages(1200, 3)
    rows = [(k, f"m{k:05}", s, b, n) for k, (s, b, n) in enumerate(sent)]
    for part in cut(rows, 3):  # each run goes on where the last one stopped
        spark.createDataFrame(part, MESSAGE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        once = sensors.once_by_sequence(spark.readStream.schema(MESSAGE).parquet(str(tmp_path / "in")))
        once.writeStream.option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination(60)
    table = by_sequence(spark.createDataFrame(rows, MESSAGE), block=100)
    stored = spark.read.schema(MESSAGE).parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, table.select(stored.columns).collect()))


def run(spark, folder, parts, wait=None, **options):
    """The stream over parts that come one after the other, begun again for each; with ``wait``, left running until no detection is pending."""
    for k, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(fusion.INPUT).parquet(f"{folder}/in")
        last = wait and k == len(parts) - 1
        trigger = {"processingTime": "1 second"} if last else None
        query = online.fuse_stream(stream, f"{folder}/out", f"{folder}/cp", trigger=trigger, **options)
        if not last:
            assert query.awaitTermination(120)
            continue
        states, until = online.States(spark, f"{folder}/out/state"), time.time() + wait
        while time.time() < until and not query.exception():
            time.sleep(2)
            done = states.numbers()
            if len(done) > 1 and states.before(done[-1] + 1)["pending"].isEmpty() and states.before(done[-1] + 1)["learning"].isEmpty():
                break
        query.stop()
        assert query.exception() is None
    return online.States(spark, f"{folder}/out/state")


def vehicles(lane=1, tunnel="T9", n=40, gap=45_000, half=750, seed=1):
    rng, rows = random.Random(seed), []
    for k in range(n):
        v = rng.uniform(70, 95)
        for i, p in enumerate(domain.POSITIONS):
            at = int(k * gap + i * half / (v / 3.6) * 1000 + rng.gauss(0, 15))
            rows.append((p, at, {"speed": v * rng.gauss(1, 0.02), "length": 9.5 + rng.gauss(0, 0.2), "plate": f"{tunnel} {k}", "lane": lane, "tunnel": tunnel}))
    return sorted(rows, key=lambda r: r[1])


@pytest.mark.parametrize("cuts", [2])
def test_an_uncalibrated_stream_learns_and_fuses_as_the_table_does(spark, tmp_path, cuts):
    rows = sorted(vehicles() + vehicles(tunnel="T8", half=1100, seed=2), key=lambda r: r[1])
    seen = sensed(spark, rows).withColumn("seq", F.monotonically_increasing_id()).cache()
    ends = [0, *[len(rows) * (k + 1) // (cuts + 1) for k in range(cuts)], len(rows)]
    parts = [seen.where(f"arrival >= {a} AND arrival < {b}") for a, b in zip(ends, ends[1:], strict=False)]
    states = run(spark, str(tmp_path), parts, wait=150, for_s=900.0, use_noise=False, idle_s=4.0, behind_s=None)
    end = states.before(10**9)
    table = fusion.placed(by_sequence(seen))
    spacing = fusion.calibrated(table, for_s=900)
    exact = lambda df, *keys: {tuple(r[k] for k in keys): [r[c] for c in sorted(df.columns) if c not in keys] for r in df.collect()}
    as_dict = lambda df, *keys: {k: pytest.approx(v) for k, v in exact(df, *keys).items()}
    assert exact(end["spacing"], "tunnel_id") == as_dict(spacing, "tunnel_id") and spacing.count() == 2
    events = fusion.associated(table, spacing)
    streamed = spark.read.parquet(f"{tmp_path}/out/events")
    assert sorted(map(str, (r["detections"] for r in streamed.collect()))) == sorted(map(str, (r["detections"] for r in events.collect())))
    of_sensors, of_tunnels = fusion.learned_noise(events)
    assert exact(end["sensors"], "tunnel_id", "position") == as_dict(of_sensors, "tunnel_id", "position")
    assert exact(end["tunnels"], "tunnel_id") == as_dict(of_tunnels, "tunnel_id")
    assert len(states.numbers()) <= 2 and end["votes"].isEmpty()  # states do not pile up


def test_what_is_learned_is_used(spark, tmp_path):
    rows = vehicles(n=30)
    seen = sensed(spark, rows).withColumn("seq", F.col("arrival")).cache()
    known = spark.createDataFrame([("T9", 765.0)], "tunnel_id string, half_m double")  # somewhat too far
    end = run(spark, str(tmp_path), [seen.where("arrival < 45"), seen.where("arrival >= 45")], known=known, idle_s=None).before(10**9)
    moved = end["tunnels"].collect()[0]
    assert 750 < moved["half_m"] < 765 and moved["mid_var"] < 0.0025
    assert {r["sensors"] for r in spark.read.parquet(f"{tmp_path}/out/events").collect()} == {3}


def test_tunnels_without_a_clear_spacing_do_not_pile_up(spark, tmp_path):
    rows = [("start", 10_000 * k, {"length": 4.0, "plate": "", "tunnel": "T7"}) for k in range(60)]
    seen = sensed(spark, rows).cache()
    states = run(spark, str(tmp_path), [seen.where(f"arrival >= {a} AND arrival < {a + 20}") for a in (0, 20, 40)], for_s=100.0, idle_s=None, behind_s=None)
    end = states.before(10**9)
    lost = spark.read.parquet(f"{tmp_path}/out/uncalibrated")
    assert end["pending"].count() + lost.count() == 60 and lost.count() >= 30
    assert end["clocks"].collect()[0]["began"] > START / 1000  # it begins anew


def test_a_silent_stream_gives_out_what_it_holds(spark, tmp_path):
    rows = [("start", 0), ("middle", 30_000), ("end", 60_000), ("start", 61_000), ("middle", 91_000)]
    known = spark.createDataFrame([("T9", 750.0)], "tunnel_id string, half_m double")
    began = time.time()
    run(spark, str(tmp_path), [sensed(spark, rows)], wait=240, known=known, idle_s=3.0, behind_s=None)
    found = sorted(r["sensors"] for r in spark.read.parquet(f"{tmp_path}/out/events").collect())
    assert found == [2, 3] and time.time() - began < 235


def test_late_detections_are_kept_apart(spark, tmp_path):
    known = spark.createDataFrame([("T9", 750.0)], "tunnel_id string, half_m double")
    parts = [sensed(spark, [("start", ms)]).withColumns({"message_id": F.lit(name), "seq": F.lit(k).cast("long")}) for k, (name, ms) in enumerate((("a", 10**7), ("b", 2 * 10**7), ("late", 0)))]
    run(spark, str(tmp_path), parts, known=known, lateness_s=600.0, idle_s=None)
    assert [r["message_id"] for r in spark.read.parquet(f"{tmp_path}/out/late").collect()] == ["late"]


def test_a_stream_of_busy_tunnels_gives_the_events_of_the_table(spark, tmp_path):
    known = domain.profiles(spark).select("tunnel_id", (F.col("length_m") / 2).alias("half_m"))
    seen = traffic.detections(traffic.vehicles(spark, domain.profiles(spark), 60, rate_s=0.03)).select(*online.COLUMNS).cache()
    cuts = [0, *seen.approxQuantile("arrival", [0.33, 0.66], 0.01), 2**62]
    parts = [seen.where((F.col("arrival") >= low) & (F.col("arrival") < high)) for low, high in zip(cuts, cuts[1:], strict=False)]
    states = run(spark, str(tmp_path), parts, known=known, use_noise=False, idle_s=None, behind_s=None, lateness_s=1e9)
    streamed = [r["detections"] for r in spark.read.parquet(f"{tmp_path}/out/events").collect()]
    table = {tuple(r["detections"]) for r in fusion.fuse(seen, known).collect()}
    pending = {r["message_id"] for r in states.before(10**9)["pending"].collect()}
    assert len(streamed) > 50 and {tuple(d) for d in streamed} <= table
    assert {m for d in table for m in d} == {m for d in streamed for m in d} | pending  # nothing is lost
    assert not {m for d in streamed for m in d} & pending


def test_traffic_windows_of_a_stream_are_those_of_the_table(spark, tmp_path):
    rng = random.Random(4)
    schema = "tunnel_id string, ts_entry long, direction string, classification string, speed_kmh double"
    rows = sorted((rng.choice("AB"), START + rng.randrange(900_000), rng.choice(domain.DIRECTIONS), rng.choice(("OTOMOBIL", "KAMYON")), round(rng.uniform(60, 90), 1)) for _ in range(80))
    rows = [*sorted(rows, key=lambda r: r[1]), ("A", START + 10 * 3_600_000, "start_to_end", "OTOMOBIL", 50.0)]  # the last one moves the watermark on
    tunnels = spark.createDataFrame([("A",), ("B",), ("IDLE",)], "tunnel_id string")
    for part in cut(rows, 3):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        events = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).withColumn("at", F.timestamp_millis("ts_entry"))
        report = sensors.traffic_windows(events, tunnels, START, delay="30 minutes")
        report.writeStream.option("checkpointLocation", str(tmp_path / "cp")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination(60)
    stored = spark.read.schema(sensors.REPORT).parquet(str(tmp_path / "out"))
    upto = START // 60_000 * 60 + 900 + 60
    table = fusion.traffic_report(spark.createDataFrame(rows, schema).withColumn("learned", F.lit(True)), 60, tunnels, START, upto * 1000)
    as_set = lambda df: sorted((r["window"], r["tunnel_id"], r["vehicles"], tuple(sorted(r["counts"].items())), r["avg_speed_kmh"]) for r in df.collect())
    for a, b in zip(as_set(stored.where(f"window < {upto}")), as_set(table), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=0.1001)  # sums in another order may round to the other side
    assert table.where("vehicles = 0 AND tunnel_id = 'IDLE'").count() == 16
    assert stored.count() == stored.select("window", "tunnel_id").distinct().count()
