"""Minute and hour states of vehicle events as stored tables that panels read.

Each input is taken in once. Of its events those are new whose ids no earlier input of the same day
had; their states are merged with the stored ones of the days they fall on, and only those days are
written. Three tables (minutes, hours, ids) change in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adit.operators import rollup
from adit.operators.dedup import first_seen
from adit.operators.lineage import checkpointed
from adit.operators.versions import Store

_STATE = (
    "tunnel_id string, direction string, classification string, vehicles long, speed_avg struct<sum:double,count:long>, speed_min double, speed_max double, "
    "speed_sketch map<int,long>, length_avg struct<sum:double,count:long>"
)
SCHEMAS = {"minute": f"minute timestamp_ntz, {_STATE}", "hour": f"hour timestamp_ntz, {_STATE}", "ids": "event_id string"}
COLUMNS = ["tunnel_id", "ts_entry", "direction", "classification", "speed_kmh", "length_m"]
ORDER = ["kafka_partition", "kafka_offset"]


def _day(ts: str):
    return F.date_format(ts, "yyyy-MM-dd").alias("day")


def take_in(store: Store, vehicles: DataFrame, name: str) -> int:
    """Add an input (called ``name``) to the stored states; one that was taken in already changes nothing."""
    number, manifest, taken = store.current()
    if name in taken:
        return number
    events = first_seen(vehicles, "event_id", ORDER, COLUMNS).withColumn("day", _day("ts_entry"))
    events = checkpointed(events)
    days = {r["day"] for r in events.select("day").distinct().collect()}  # one row a day
    if number:
        events = checkpointed(events.join(store.read("ids", SCHEMAS["ids"], days, manifest), "event_id", "left_anti"))
    parts = {"ids": _with_days(store, "ids", days, manifest).unionByName(events.select("event_id", "day"))}
    for unit in ("minute", "hour"):
        new = rollup.rollup(events, unit)
        if number:
            new = rollup.merge(store.read(unit, SCHEMAS[unit], days, manifest).unionByName(new.select(*_names(unit))), [unit, *rollup.KEYS])
        parts[unit] = new.select(*_names(unit), _day(unit))
    return store.commit(parts, [name], after=number)


def _names(unit: str) -> list[str]:
    return [unit, "tunnel_id", "direction", "classification", "vehicles", "speed_avg", "speed_min", "speed_max", "speed_sketch", "length_avg"]


def _with_days(store: Store, part: str, days: set[str], manifest: dict) -> DataFrame:
    rows = store.spark.createDataFrame([], SCHEMAS[part] + ", day string")
    for day in sorted(days & set(manifest.get(part, {}))):
        rows = rows.unionByName(store.read(part, SCHEMAS[part], {day}, manifest).withColumn("day", F.lit(day)))
    return rows


def read(store: Store, unit: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Stored states of a unit, of the days from ``since`` to ``until`` (yyyy-mm-dd)."""
    _, manifest, _ = store.current()
    days = {d for d in manifest.get(unit, {}) if (since is None or d >= since) and (until is None or d <= until)}
    return store.read(unit, SCHEMAS[unit], days, manifest)
