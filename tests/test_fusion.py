"""Fusion: the choice against a plain greedy one, events by hand, calibration, noise, stream and batch, quality."""

import math

import pytest
import traffic
from pyspark.sql import functions as F

from adit.operators.dedup import by_sequence
from adit.operators.lineage import checkpointed
from adit.sources import domain
from adit.streaming import fusion

START = 1_750_000_000_000


def sensed(spark, rows):
    """Detections from (position, milliseconds, and what differs from a plain car)."""
    out = []
    for k, (position, ms, *more) in enumerate(rows):
        d = {"plate": "06 KD 41", "kind": "OTOMOBIL", "confidence": 0.9, "lane": 2, "direction": "start_to_end", "speed": 90.0, "length": 4.2, "tunnel": "T9"} | (more[0] if more else {})
        out.append((d["tunnel"], f"{position[0]}{k}", f"{d['tunnel']}-{position}", "b", k, START + ms, d["direction"], position, d["lane"], d["plate"], d["speed"], d["length"], d["confidence"], d["kind"], k))
    return spark.createDataFrame(out, fusion.INPUT)


def fused(spark, rows, half=750.0, **options):
    known = spark.createDataFrame([("T9", half)], "tunnel_id string, half_m double")
    return sorted((r.asDict() for r in fusion.fuse(sensed(spark, rows), known, **options).collect()), key=lambda e: (e["ts_entry"], e["lane"]))


def test_one_vehicle_at_90_in_each_direction(spark):
    # 750 m at 25 m/s take 30 s
    rows = [("start", 0), ("middle", 30_000), ("end", 60_000)] + [(p, 5_000 + 30_000 * i, {"direction": "end_to_start", "lane": 1, "plate": ""}) for i, p in enumerate(("end", "middle", "start"))]
    a, b = fused(spark, rows)
    assert (a["ts_entry"] - START, a["ts_exit"] - START, a["speed_kmh"], a["sensors"], a["missing"], a["plate"]) == (0, 60_000, 90.0, 3, [], "06 KD 41")
    assert (b["ts_entry"] - START, b["direction"], b["lane"], b["sensors"], b["plate"]) == (5_000, "end_to_start", 1, 3, "")


def test_a_missed_sensor_leaves_a_pair_and_a_lone_detection_an_event(spark):
    rows = [("start", 0), ("end", 60_500), ("start", 200_000, {"lane": 1}), ("middle", 230_400, {"lane": 1}), ("middle", 500_000, {"lane": 3})]
    a, b, c = fused(spark, rows)
    assert (a["sensors"], a["missing"], b["sensors"], b["missing"], c["sensors"], c["missing"]) == (2, ["middle"], 2, ["end"], 1, ["start", "end"])
    assert b["ts_exit"] - START == 200_000 + 2 * 30_400 and c["ts_entry"] - START == 470_000


def test_other_plates_other_lanes_and_other_lengths_do_not_fuse(spark):
    assert [e["sensors"] for e in fused(spark, [("start", 0, {"plate": "X 1"}), ("middle", 30_000, {"plate": "Y 2"})])] == [1, 1]
    assert [e["sensors"] for e in fused(spark, [("start", 0), ("middle", 30_000, {"lane": 1})])] == [1, 1]
    assert [e["sensors"] for e in fused(spark, [("start", 0, {"plate": "", "length": 16.0}), ("middle", 30_000, {"plate": ""})])] == [1, 1]
    three = [("start", 0, {"plate": "X 1"}), ("middle", 30_000, {"plate": ""}), ("end", 60_000, {"plate": ""})]
    assert [e["plate"] for e in fused(spark, three)] == ["X 1"]
    apart = [("start", 0, {"plate": "X 1"}), ("middle", 30_000, {"plate": "Y 2"}), ("end", 60_000, {"plate": ""})]
    assert sorted(e["sensors"] for e in fused(spark, apart, strict_plates=True)) == [1, 2]


def plain_vote(seen):
    odds = {}
    for kind, c in seen:
        if kind != domain.UNKNOWN:
            odds[kind] = odds.get(kind, 0) + math.log(min(max(c, 0.5), 0.999) * 8 / (1 - min(max(c, 0.5), 0.999)))
    best = sorted(odds.values(), reverse=True) + [0.0, 0.0]
    kind = next((k for k in odds if odds[k] == best[0]), domain.UNKNOWN)
    sure = 1 / (1 + math.exp(-min(best[0] - best[1], 30))) if len(seen) > 1 else min(seen[0][1], 0.999)
    return kind, round(sure, 3), round(sum(k == kind for k, _ in seen) / len(seen), 3)


def test_votes_by_hand(spark):
    kinds, cases = ("KAMYON", "OTOBUS", domain.UNKNOWN), []
    for k in range(27):
        cases.append([(kinds[k // 9], 0.55 + 0.05 * (k % 7)), (kinds[k // 3 % 3], 0.97), (kinds[k % 3], 0.6 + 0.01 * k)])
    cases += [[("MINIBUS", 0.9995)], [(domain.UNKNOWN, 0.3), ("TRAKTOR", 0.2)]]
    rows = spark.createDataFrame([(k, [{"kind": a, "confidence": c} for a, c in case]) for k, case in enumerate(cases)], "k int, seen array<struct<kind: string, confidence: double>>")
    for r in rows.select("k", fusion.votes_of(F.col("seen")).alias("v")).collect():
        assert (r["v"]["kind"], round(r["v"]["sure"], 3), round(r["v"]["agreement"], 3)) == plain_vote(cases[r["k"]])


def plain_choice(rows, half):
    """Greedy over all triplets, then over all pairs, tried one by one."""
    s = [dict(t=r["ts"] / 1000, v=r["speed_kmh"] / 3.6, l=r["length_m"], p=r["plate"], i=("start", "middle", "end").index(r["position"]), id=r["message_id"], lane=r["lane"]) for r in rows]
    room = lambda dt, var, sigma: 0.25 + abs(dt) * max(0.03, sigma * min(math.sqrt(var), 0.5))
    agree = lambda a, b: not a["p"] or not b["p"] or a["p"] == b["p"]
    near = lambda late, early, hops: agree(late, early) and abs(late["t"] - hops * half / late["v"] - early["t"]) <= room(hops * half / late["v"], 0.0009, 5)
    by = lambda i: [x for x in s if x["i"] == i]
    whole, two = [], []
    for z in by(2):
        for m in by(1):
            if m["lane"] == z["lane"] and near(z, m, 1):
                for f in by(0):
                    if f["lane"] == z["lane"] and agree(z, f) and z["t"] > f["t"] and abs(f["t"] - 2 * m["t"] + z["t"]) <= 0.25:
                        v, mean = 2 * half / (z["t"] - f["t"]), (f["l"] + m["l"] + z["l"]) / 3
                        score = ((f["t"] - 2 * m["t"] + z["t"]) / 0.05) ** 2 + sum(((x["v"] - v) / v) ** 2 / 0.0009 + (x["l"] - mean) ** 2 / 0.36 for x in (f, m, z))
                        whole.append((score, (f["id"], m["id"], z["id"])))
    for a in s:
        for b in s:
            if a["i"] < b["i"] and a["lane"] == b["lane"] and near(b, a, b["i"] - a["i"]):
                v = (a["v"] + b["v"]) / 2
                hop = (b["i"] - a["i"]) * half / v
                slack, off = room(hop, 0.00045, 3), b["t"] - a["t"] - hop
                if abs(off) <= slack:
                    two.append(((3 * off / slack) ** 2 + ((a["v"] - b["v"]) / v) ** 2 / 0.0018 + (a["l"] - b["l"]) ** 2 / 0.72, (a["id"], b["id"])))
    used, out = set(), set()
    for groups, limit in ((whole, 25), (two, 18)):
        for score, ids in sorted(groups):
            if score < limit and not used & set(ids):
                used |= set(ids)
                out.add(ids)
    return out | {(x["id"],) for x in s if x["id"] not in used}


def test_the_choice_is_that_of_a_plain_search(spark):
    import random

    rng, rows = random.Random(5), []
    for k in range(60):  # dense: about a vehicle a second in two lanes, plates mostly unread
        at, v, length, lane = k * 1_100, rng.uniform(80, 95), rng.choice((4.0, 4.5, 9.0)), rng.randrange(1, 3)
        for i, p in enumerate(domain.POSITIONS):
            if rng.random() > 0.15:
                rows.append((p, int(at + i * 750 / (v / 3.6) * 1000 + rng.gauss(0, 20)), {"speed": v * rng.gauss(1, 0.03), "length": length + rng.gauss(0, 0.3), "lane": lane, "plate": f"P {k}" if rng.random() < 0.3 else ""}))
    found = {tuple(e["detections"]) for e in fused(spark, rows)}
    assert found == plain_choice([r.asDict() for r in sensed(spark, rows).collect()], 750.0)
    assert any(len(ids) == 2 for ids in found) and any(len(ids) == 1 for ids in found)


def plain_sequence(sent, window=512):
    """Places of the messages (sensor, boot, number) that count."""
    out, of = [], {}
    for k, (sensor, boot, n) in enumerate(sent):
        last, top, seen = of.get(sensor, (None, None, set()))
        if boot != last:
            top, seen = None, set()
        if n not in seen and (top is None or n > top - window):
            out.append(k)
        of[sensor] = boot, n if top is None else max(n, top), seen | {n}
    return out


def messages(n, seed):
    import random

    rng, sent, at = random.Random(seed), [], {}
    for _ in range(n):
        sensor = rng.choice("pqr")
        boot, number = at.get(sensor, ("x", 0))
        if rng.random() < 0.004:
            boot, number = rng.choice("xyz"), rng.randrange(100)
        number += rng.choice((0, 1, 1, 1, 2, 40))
        at[sensor] = boot, number
        sent.append((sensor, boot, max(0, number - rng.choice((0, 0, 0, 0, 1, 3, 100, 500, 530, 600)))))
    return sent


@pytest.mark.parametrize("block", [1, 7, 300, 10**9])
def test_sequence_numbers(spark, block):
    sent = [("s", b, n) for b, n in [("x", 5), ("x", 5), ("x", 9), ("x", 6), ("x", 600), ("x", 88), ("x", 89), ("y", 6), ("y", 7), ("x", 9)]]
    assert plain_sequence(sent) == [0, 2, 3, 4, 6, 7, 8, 9]  # 88 is 512 behind, 89 is not; boot x comes back
    for sent in (sent, messages(1500, block)):
        rows = spark.createDataFrame([(k, f"m{k}", s, b, n) for k, (s, b, n) in enumerate(sent)], "arrival long, message_id string, sensor_id string, boot_id string, seq long")
        assert sorted(r["arrival"] for r in by_sequence(rows, block=block).collect()) == plain_sequence(sent)


def test_no_task_orders_a_whole_history(spark):
    """Rows are sorted by blocks; only summaries (after an aggregation) are sorted by sensor or tunnel."""
    rows = spark.createDataFrame([], "arrival long, message_id string, sensor_id string, boot_id string, seq long")
    average = fusion.moving_average(rows, ["sensor_id"], ["arrival", "message_id"], F.col("seq"), F.lit(0.0), 0.02)
    for df in (by_sequence(rows), average):
        for node in windows_of(df):
            parts = [p for p in node["by"] if p]
            assert any(p.startswith(("_block", "_run")) for p in parts) or node["summed"], node


def windows_of(df):
    """The window nodes of a plan: what they partition by, and whether an aggregation lies below before any scan."""
    out = []

    def walk(node):
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        if node.nodeName() == "Window":
            by = [node.partitionSpec().apply(i).toString().split("#")[0] for i in range(node.partitionSpec().size())]
            out.append({"by": by, "summed": "Aggregate" in node.child().toString()})

    walk(df._jdf.queryExecution().optimizedPlan())
    assert out
    return out


def test_a_chain_of_rivals_is_settled_to_its_end(spark):
    # each group shares a detection with the next and is better than it: they go one by one
    n = 130
    seen = "array<struct<message_id:string>>"
    rows = [(k, "T", float(k), [{"message_id": f"m{k}"}, {"message_id": f"m{k + 1}"}]) for k in range(n)]
    groups = spark.createDataFrame([*rows, (n, "U", 0.5, [{"message_id": "m0"}])], f"id long, tunnel_id string, score double, seen {seen}")
    taken = sorted((r["tunnel_id"], r["seen"][0]["message_id"]) for r in fusion.matched(checkpointed(groups)).collect())
    assert taken == sorted([("T", f"m{k}") for k in range(0, n, 2)] + [("U", "m0")])  # an id of another tunnel is no rival
    linked = fusion.open_detections(groups, spark.createDataFrame([("T", "m7")], "tunnel_id string, message_id string"))
    assert linked.count() == n + 1


@pytest.mark.parametrize("block", [1, 50, 10**9])
def test_a_moving_average_is_that_of_a_plain_fold(spark, block):
    import random

    rng = random.Random(block)
    rows = [(f"k{i % 3}", rng.randrange(400), i, rng.uniform(0, 9), float(i % 3)) for i in range(300)]
    found = fusion.moving_average(spark.createDataFrame(rows, "k string, at long, id long, x double, p double"), ["k"], ["at", "id"], F.col("x"), F.col("p"), 0.02, block)
    for r in found.collect():
        ema, own = float(r["k"][1]), sorted((x for x in rows if x[0] == r["k"]), key=lambda x: x[1:3])
        for *_, x, _ in own:
            ema += 0.02 * (x - ema)
        assert r["ema"] == pytest.approx(ema) and r["n"] == len(own)


def test_votes_of_parts_add_up(spark):
    rows = [(p, 61_000 * k + int(i * 1000 * 620 / 25), {"plate": f"K {k}", "length": 9.5}) for k in range(20) for i, p in enumerate(domain.POSITIONS)]
    seen = fusion.placed(sensed(spark, rows))
    a, b = seen.where("pmod(xxhash64(message_id), 2) = 0"), seen.where("pmod(xxhash64(message_id), 2) = 1")
    parts = fusion.added_votes(fusion.spacing_votes(a), fusion.spacing_votes(b), fusion.spacing_votes(a, b), fusion.spacing_votes(b, a))
    weights = lambda votes: {r["bin"]: (r["weight"], r["mass"]) for r in votes.collect()}
    whole = weights(fusion.spacing_votes(seen))
    assert weights(parts) == {k: pytest.approx(v) for k, v in whole.items()} and whole


def test_spacing_is_the_peak_of_a_plain_histogram(spark):
    rows = [(p, 97_000 * k + int(i * 1000 * 620 / 25), {"plate": f"K {k}" if k % 7 else "", "length": 9.5, "tunnel": t}) for t in ("A", "B") for k in range(14) for i, p in enumerate(domain.POSITIONS) if t == "A" or k < 3]
    seen = fusion.placed(sensed(spark, rows))
    votes = {(r["tunnel_id"], r["bin"]): r["weight"] for r in fusion.spacing_votes(seen).collect()}
    plain, own = {}, [r.asDict() for r in seen.collect()]
    for a in own:
        for b in own:
            half = (b["t"] - a["t"]) * 25
            if a["tunnel_id"] == b["tunnel_id"] and b["index"] == a["index"] + 1 and 50 <= half <= 12_500 and (not a["plate"] or not b["plate"] or a["plate"] == b["plate"]):
                key = a["tunnel_id"], int(math.log(half) / math.log(1.01))
                plain[key] = plain.get(key, 0) + 1.0
    assert votes == pytest.approx(plain)
    found = {r["tunnel_id"]: r["half_m"] for r in fusion.calibrated(seen).collect()}
    assert found == {"A": pytest.approx(620, rel=1e-6)}  # B has too few votes


def test_noise_is_the_moving_average_of_a_plain_fold(spark):
    rows = [(p, 100_000 * k + 30_000 * i + 7 * (k % 5) * (i == 1), {"plate": f"N {k}", "speed": 90.0 + (k % 7) - 3 + i, "length": 4.2 + 0.1 * (k % 4) * i}) for k in range(25) for i, p in enumerate(domain.POSITIONS)]
    known = spark.createDataFrame([("T9", 750.0)], "tunnel_id string, half_m double")
    events = fusion.associated(fusion.placed(sensed(spark, rows)), known)
    sensors, tunnels = fusion.learned_noise(events)
    var, mid, half = {p: [0.0009, 0.36] for p in domain.POSITIONS}, 0.0025, 750.0
    for e in sorted((r for r in events.collect() if r["sensors"] == 3), key=lambda r: r["ts_exit"]):
        f, m, l = e["seen"]  # noqa: E741
        v, mean = 1500 / (l["t"] - f["t"]), (f["length_m"] + m["length_m"] + l["length_m"]) / 3
        mid += 0.02 * ((m["t"] - (f["t"] + l["t"]) / 2) ** 2 - mid)
        for s in e["seen"]:
            a = var[s["position"]]
            a[0] += 0.02 * (((s["speed"] - v) / v) ** 2 - a[0])
            a[1] += 0.02 * (1.5 * (s["length_m"] - mean) ** 2 - a[1])
        implied = (l["t"] - f["t"]) * (f["speed"] + m["speed"] + l["speed"]) / 6
        half += 0.01 * (implied - half) if abs(implied - 750) < 37.5 else 0
    for r in sensors.collect():
        assert [r["speed_var"], r["length_var"]] == pytest.approx(var[r["position"]])
    assert [tuple(r) for r in tunnels.select("mid_var", "half_m").collect()] == [(pytest.approx(mid), pytest.approx(half))]


@pytest.fixture(scope="module")
def known(spark):
    return domain.profiles(spark).select("tunnel_id", (F.col("length_m") / 2).alias("half_m"))


def quality(spark, known, degraded, passes):
    seen = traffic.detections(traffic.vehicles(spark, domain.profiles(spark), 250), degraded=degraded).cache()
    members = fusion.fuse(seen, known, passes=passes).select("tunnel_id", "event_id", "classification", F.explode("detections").alias("message_id"))
    truth = seen.select("message_id", "vehicle_id", "true_class").distinct()
    by = members.join(truth, "message_id").groupBy("tunnel_id", "event_id", "classification").agg(F.countDistinct("vehicle_id").alias("n"), F.max("true_class").alias("t")).collect()
    assert members.count() == truth.count()  # each detection in one event, repeats in none
    seen.unpersist()
    return sum(r["n"] > 1 for r in by) / len(by), sum(r["classification"] == r["t"] for r in by) / len(by)


def test_quality_of_default_sensors(spark, known):
    mixed, accuracy = quality(spark, known, 0.0, 1)
    assert mixed < 0.01 and accuracy > 0.99


def test_quality_with_degraded_sensors(spark, known):
    mixed, accuracy = quality(spark, known, 0.3, 2)
    assert accuracy > 0.94


def test_traffic_windows_have_idle_tunnels_and_gaps(spark):
    rows = [("start", 0), ("middle", 30_000), ("end", 60_000), ("start", 300_000), ("middle", 330_000), ("end", 360_000)]
    known = spark.createDataFrame([("T9", 750.0)], "tunnel_id string, half_m double")
    report = fusion.traffic_report(fusion.fuse(sensed(spark, rows), known), tunnels=spark.createDataFrame([("T9",), ("IDLE",)], "tunnel_id string")).collect()
    windows = sorted({r["window"] for r in report})
    assert len(windows) == 6 and len(report) == 12
    assert {(r["tunnel_id"], r["vehicles"]) for r in report if r["window"] in (windows[0], windows[-1])} == {("T9", 1), ("IDLE", 0)}
    assert sum(r["vehicles"] for r in report) == 2 and all(r["counts"] == {} for r in report if not r["vehicles"])
