"""Fusion of a stream: tunnels are calibrated, vehicles fused and noise learned as detections come.

A sensor's messages are taken once, by a stateful operator. Each micro-batch then runs the joins of
``fusion`` over what is pending and what is new, with small tables as state:

* ``clocks``: where each tunnel's time stands, when it was last heard of, and since when it is calibrated;
* ``votes``: the histogram of spacings of tunnels that are being calibrated. Each micro-batch adds the
  votes of pairs with a new detection, so no pair is counted twice. Once a tunnel's clock has passed
  ``for_s``, its peak becomes a row of ``spacing`` and the tunnel, with all that is pending, is fused;
  without a clear peak its detections so far go to ``uncalibrated`` and it begins anew;
* ``pending``: detections whose vehicle is not out yet;
* ``learning``: whole triplets that are out but may be followed by one that left the tunnel before;
  ``sensors``, ``tunnels``: noise and refined spacing, averages that go on in order of exit.

Time of a tunnel is that of its last detection. One that falls silent is moved on by the clock of all
tunnels, ``behind_s`` behind it, and by the wall clock, once nothing has come for ``idle_s``: a second
source ticks once a second, so that micro-batches come without input too, and a stream that ends gives
out what it holds.

States and output of a micro-batch lie in folders under its number; a batch that runs again replaces its
own, and states older than the last one are removed.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adit.operators.alerts import dimension
from adit.operators.lineage import checkpointed
from adit.sources import domain
from adit.streaming import fusion
from adit.streaming.sensors import once_by_sequence

COLUMNS = [c.split()[0] for c in fusion.INPUT.split(", ")]
_SEEN = "array<struct<message_id:string,index:int,t:double,speed:double,length_m:double,plate:string,kind:string,confidence:double,position:string,speed_var:double,length_var:double>>"
STATES = {
    "clocks": "tunnel_id string, began double, clock double, heard double",
    "votes": "tunnel_id string, bin int, weight double, mass double",
    "spacing": "tunnel_id string, half_m double",
    "pending": fusion.INPUT,
    "learning": f"tunnel_id string, ts_exit long, event_id string, learned boolean, sensors int, seen {_SEEN}, _speed double, _half double, _mid_var double",
    "sensors": "tunnel_id string, position string, speed_var double, length_var double",
    "tunnels": "tunnel_id string, mid_var double, half_m double",
}


class States:
    """The state tables under ``path``, one folder a micro-batch; a folder counts once it is complete."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, below: str):
        return self.hadoop.Path(f"{self.path}/{below}" if below else self.path)

    def numbers(self) -> list[int]:
        """The complete ones, in order."""
        if not self.fs.exists(self._at("")):
            return []
        names = [f.getPath().getName() for f in self.fs.listStatus(self._at(""))]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch=") and self.fs.exists(self._at(f"{n}/_complete")))

    def before(self, number: int) -> dict[str, DataFrame]:
        """What held before a micro-batch: the last complete tables, or empty ones."""
        last = max((n for n in self.numbers() if n < number), default=None)
        read = lambda name: self.spark.read.schema(STATES[name]).parquet(f"{self.path}/batch={last}/{name}")
        return {name: self.spark.createDataFrame([], schema) if last is None else read(name) for name, schema in STATES.items()}

    def put(self, number: int, tables: dict[str, DataFrame]) -> None:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{self.path}/batch={number}/{name}")
        self.fs.create(self._at(f"batch={number}/_complete"), True).close()
        for old in self.numbers()[:-2]:  # a batch that runs again needs the one before it
            self.fs.delete(self._at(f"batch={old}"), True)


def moved_clocks(before: DataFrame, new: DataFrame, now: float, idle_s: float | None, behind_s: float | None) -> DataFrame:
    """``clocks`` after new detections (as from ``placed``), and ``reached``, where time stands with silent tunnels moved on."""
    came = new.groupBy("tunnel_id").agg(F.min("t").alias("_first"), F.max("t").alias("_last"))
    clocks = before.join(came, "tunnel_id", "full").select(
        "tunnel_id", F.coalesce("began", "_first").alias("began"), F.greatest("clock", "_last").alias("clock"), F.when(F.col("_last").isNotNull(), now).otherwise(F.col("heard")).alias("heard")
    )
    reached = F.col("clock")
    if idle_s is not None:
        silent = now - F.col("heard")
        reached = F.when(silent >= idle_s, reached + silent).otherwise(reached)
    clocks = clocks.withColumn("reached", reached)
    if behind_s is not None:
        clocks = clocks.crossJoin(F.broadcast(clocks.agg((F.max("clock") - behind_s).alias("_all")))).withColumn("reached", F.greatest("reached", "_all")).drop("_all")  # one row
    return checkpointed(clocks)


def calibration(was: dict[str, DataFrame], old: DataFrame, new: DataFrame, clocks: DataFrame, known: DataFrame | None, for_s: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Votes, spacing (learned ones only) and failed tunnels (``tunnel_id, until``) after a micro-batch.

    ``old`` and ``new`` as from ``placed``: what was pending, and what has come.
    """
    spacing = was["spacing"] if known is None else was["spacing"].unionByName(known.select("tunnel_id", "half_m"))
    open_ones = checkpointed(clocks.join(dimension(spacing.select("tunnel_id")), "tunnel_id", "left_anti").select("tunnel_id", (F.col("began") + for_s).alias("until"), "reached"))
    if open_ones.isEmpty():
        return was["votes"].limit(0), was["spacing"], open_ones.select("tunnel_id", "until")
    within = lambda rows: rows.join(dimension(open_ones.drop("reached")), "tunnel_id").where("t < until").drop("until")
    old, new = within(old), checkpointed(within(new))
    votes = was["votes"].join(dimension(open_ones.select("tunnel_id")), "tunnel_id", "left_semi")
    if not new.isEmpty():
        votes = fusion.added_votes(votes, fusion.spacing_votes(new), fusion.spacing_votes(old, new), fusion.spacing_votes(new, old))
    votes = checkpointed(votes)
    due = open_ones.where("reached >= until")
    found = checkpointed(fusion.spacing_peaks(votes.join(dimension(due.select("tunnel_id")), "tunnel_id", "left_semi")))
    failed = checkpointed(due.join(dimension(found.select("tunnel_id")), "tunnel_id", "left_anti").select("tunnel_id", "until"))
    return votes.join(dimension(due.select("tunnel_id")), "tunnel_id", "left_anti"), was["spacing"].unionByName(found), failed


def learned(was: dict[str, DataFrame], events: DataFrame, pending: DataFrame, clocks: DataFrame) -> dict[str, DataFrame]:
    """``learning``, ``sensors`` and ``tunnels`` after a micro-batch's final events.

    Averages depend on the order of exits: a triplet counts once no earlier exit can follow, that is,
    once all detections of its tunnel that are pending are later.
    """
    columns = [c.split()[0] for c in STATES["learning"].split(", ")[:5]] + ["seen", "_speed", "_half", "_mid_var"]
    whole = was["learning"].unionByName(events.where("final AND learned AND sensors = 3").select(*columns))
    oldest = pending.groupBy("tunnel_id").agg((F.min("ts") / 1000).alias("_oldest"))
    front = clocks.join(oldest, "tunnel_id", "left").select("tunnel_id", F.least("_oldest", "reached").alias("front"))
    whole = checkpointed(whole.join(dimension(front), "tunnel_id").withColumn("ready", F.col("ts_exit") < F.col("front") * 1000).drop("front"))
    a, b = fusion.learned_noise(whole.where("ready"), (was["sensors"], was["tunnels"]))
    kept = was["tunnels"].select("tunnel_id", F.col("half_m").alias("_was"))
    b = b.join(kept, "tunnel_id", "left").select("tunnel_id", "mid_var", F.coalesce("half_m", "_was").alias("half_m"))
    sensors = a.unionByName(was["sensors"].join(a.select("tunnel_id", "position"), ["tunnel_id", "position"], "left_anti"))
    tunnels = b.unionByName(was["tunnels"].join(b.select("tunnel_id"), "tunnel_id", "left_anti"))
    return {"learning": whole.where("NOT ready").drop("ready"), "sensors": sensors, "tunnels": tunnels}


def fuse_stream(
    detections: DataFrame,
    path: str,
    checkpoint: str,
    known: DataFrame | None = None,
    strict_plates: bool = False,
    for_s: float = fusion.CALIBRATE_S,
    use_noise: bool = True,
    lateness_s: float = 4_500.0,
    behind_s: float | None = 600.0,
    idle_s: float | None = 60.0,
    dedup_window: int = 512,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the vehicle events of a stream of detections (columns of ``fusion.INPUT``) to ``path/events``.

    ``known`` has ``tunnel_id, half_m`` of tunnels that need no calibration. An event goes out once the
    clock has passed the deadline of each of its detections and a crossing more, and the same is true of
    all that competes with it. Noise is learned always, and used from the next micro-batch on with
    ``use_noise``. A detection more than ``lateness_s`` behind its tunnel's clock goes to ``path/late``.
    """
    spark = detections.sparkSession
    states = States(spark, f"{path}/state")
    put = lambda table, name, number: table.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")

    def step(batch: DataFrame, number: int) -> None:
        now, was = time.time(), states.before(number)
        batch = batch.where("tunnel_id IS NOT NULL")  # others are ticks
        came = checkpointed(batch.select(*COLUMNS).join(dimension(was["clocks"].select("tunnel_id", F.col("clock").alias("_clock"))), "tunnel_id", "left"))
        if came.isEmpty() and (idle_s is None or was["pending"].isEmpty() or was["clocks"].where(F.lit(now) - F.col("heard") >= idle_s).isEmpty()):
            return  # nothing new, and no clock has moved
        late = F.coalesce(F.col("ts") / 1000 < F.col("_clock") - lateness_s, F.lit(False))
        put(came.where(late).drop("_clock"), "late", number)
        fresh = came.where(~late).drop("_clock").select(*COLUMNS)
        clocks = moved_clocks(was["clocks"], fusion.placed(fresh), now, idle_s, behind_s)
        votes, spacing, failed = calibration(was, fusion.placed(was["pending"]), fusion.placed(fresh), clocks, known, for_s)
        rows = was["pending"].unionByName(fresh).join(dimension(failed), "tunnel_id", "left")
        rows = checkpointed(rows.withColumn("_lost", F.coalesce(F.col("ts") / 1000 < F.col("until"), F.lit(False))).drop("until"))
        put(rows.where("_lost").drop("_lost"), "uncalibrated", number)
        rows = rows.where("NOT _lost").drop("_lost")
        all_spacing = checkpointed(spacing if known is None else reduce(DataFrame.unionByName, [spacing, known.select("tunnel_id", "half_m")]))
        noise = (was["sensors"], was["tunnels"]) if use_noise else None
        events = fusion.associated(fusion.placed(rows), all_spacing, noise, strict_plates, clocks.select("tunnel_id", F.col("reached").alias("clock")), closed=True)
        events = checkpointed(events.where("final"))
        put(events.drop(*fusion._INNER), "events", number)
        pending = checkpointed(rows.join(events.select("tunnel_id", F.explode("detections").alias("message_id")), ["tunnel_id", "message_id"], "left_anti"))
        began = clocks.join(dimension(failed), "tunnel_id", "left").withColumn("began", F.coalesce("until", "began")).drop("until", "reached")
        states.put(number, {"clocks": began, "votes": votes, "spacing": spacing, "pending": pending.select(*COLUMNS), **learned(was, events, pending, clocks)})

    once = once_by_sequence(detections.select(*COLUMNS), dedup_window)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    once = once.unionByName(ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in once.schema]))
    return once.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def fuse_topic(raw: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    """``fuse_stream`` of the topic of detections as its source gives it: JSON in ``value``.

    A detection arrives with its record's ``timestamp``, without one at its own time. The boot is the
    middle part of ``message_id`` (``sensor:boot:seq``), empty where there is none. Records that
    are none of the topic's schema are left out; ``pipeline.load_topic`` stores them.
    """
    rows, _ = domain.read_topic(raw, "detections")
    stamp = F.unix_millis("timestamp") if "timestamp" in raw.columns else F.lit(None)
    boot = F.coalesce(F.get(F.split("message_id", ":", -1), F.lit(1)), F.lit(""))
    rows = rows.withColumns({"boot_id": boot, "arrival": F.coalesce(stamp, "ts")})
    return fuse_stream(rows.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in fusion.INPUT.split(", ")]), path, checkpoint, **options)
