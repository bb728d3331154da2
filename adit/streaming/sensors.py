"""Streams with state by key: a sensor's messages once each, a tunnel's traffic by windows and timers.

Both need the state store that keeps several values a key:
``spark.sql.streaming.stateStore.providerClass`` set to the RocksDB provider (``STORE``).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
REPORT = "window long, tunnel_id string, vehicles long, counts map<string,bigint>, avg_speed_kmh double"


class Sequence:
    """What is known of one sensor: its boot, the highest number of it, and which of the last ``window`` were seen.

    ``ring`` is a whole number of ``window`` bits: bit k stands for the number k below the highest.
    """

    def __init__(self, window: int, boot: str | None = None, top: int | None = None, ring: int = 0):
        self.window, self.boot, self.top, self.ring = window, boot, top, ring

    def take(self, boots: list[str | None], numbers: np.ndarray) -> np.ndarray:
        """Which of these messages, in order of arrival, count."""
        before = [self.boot, *boots[:-1]]
        cuts = [k for k, (a, b) in enumerate(zip(before, boots, strict=True)) if a is not None and b is not None and a != b]
        counts = np.zeros(len(numbers), bool)
        for start, end in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
            if start in cuts:
                self.top, self.ring = None, 0
            if end > start:
                counts[start:end] = self._run(numbers[start:end])
        self.boot = boots[-1]
        return counts

    def _run(self, numbers: np.ndarray) -> np.ndarray:
        low = np.iinfo(np.int64).min
        tops = np.maximum.accumulate(np.concatenate([[low if self.top is None else self.top], numbers]))
        counts = ~pd.Series(numbers).duplicated().to_numpy()
        with np.errstate(over="ignore"):
            counts &= (tops[:-1] == low) | (numbers > tops[:-1] - self.window)
        if self.top is not None:
            counts &= np.array([n > self.top or not self.ring >> int(self.top - n) & 1 if n > self.top - self.window else False for n in numbers], bool)
        top = int(tops[-1])
        ring = 0 if self.top is None else self.ring << min(top - self.top, self.window)
        for n in numbers[counts]:
            if n > top - self.window:
                ring |= 1 << int(top - n)
        self.top, self.ring = top, ring & ((1 << self.window) - 1)
        return counts


class OncePerSequence(StatefulProcessor):
    """Of a sensor's messages those that count, see ``dedup.by_sequence``. State: boot, highest number, one ring of bits."""

    def __init__(self, window: int):
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("sequence", "boot string, top long, ring binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["arrival", "message_id"], kind="stable")
        known = self.state.get()
        seen = Sequence(self.window, known[0], known[1], int.from_bytes(known[2], "big")) if known else Sequence(self.window)
        boots = [None if pd.isna(b) else b for b in batch["boot_id"]]
        counts = seen.take(boots, batch["seq"].to_numpy(np.int64))
        self.state.update((seen.boot, seen.top, seen.ring.to_bytes(-(-self.window // 8), "big")))
        yield batch[counts]

    def close(self) -> None:
        pass


def once_by_sequence(detections: DataFrame, window: int = 512) -> DataFrame:
    """A stream's messages that count, by sensor, boot and sequence number, as ``dedup.by_sequence`` of the table.

    A micro-batch is taken in its order of arrival.
    """
    once = detections.where("seq IS NOT NULL").groupBy("sensor_id")
    return once.transformWithStateInPandas(OncePerSequence(window), detections.schema, "Append", "None")


class TrafficWindows(StatefulProcessor):
    """A tunnel's report for each window, given out by a timer once the watermark has passed the window's end."""

    def __init__(self, window_s: int, start_ms: int):
        self.window_s = window_s
        self.start = start_ms // (1000 * window_s) * window_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "window long")  # the next window to report
        self.sums = handle.getMapState("sums", "window long, kind string", "n long, speed double")

    def _begin(self) -> None:
        if not self.due.exists():
            self.due.update((self.start,))
            self.handle.registerTimer((self.start + self.window_s) * 1000)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        self._begin()

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._begin()
        due = self.due.get()[0]
        for batch in rows:
            batch = batch.assign(window=batch["ts_entry"] // (1000 * self.window_s) * self.window_s, kind=batch["direction"] + "/" + batch["classification"])
            batch = batch[batch["window"] >= due]  # what comes after its window's report is late
            for (window, kind), speeds in batch.groupby(["window", "kind"])["speed_kmh"]:
                at = (int(window), kind)
                n, total = self.sums.getValue(at) if self.sums.containsKey(at) else (0, 0.0)
                self.sums.updateValue(at, (n + len(speeds), total + float(speeds.sum())))
        yield pd.DataFrame(columns=["window", "tunnel_id", "vehicles", "counts", "avg_speed_kmh"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, due = timerValues.getCurrentWatermarkInMs(), self.due.get()[0]
        of: dict[int, dict[str, tuple[int, float]]] = {}
        for (window, kind), (n, total) in self.sums.iterator():
            if (window + self.window_s) * 1000 <= now:
                of.setdefault(window, {})[kind] = (n, total)
        out = []
        while (due + self.window_s) * 1000 <= now:  # all that the watermark has passed, at once
            kinds = of.get(due, {})
            n = sum(k for k, _ in kinds.values())
            speed = sum(s for _, s in kinds.values()) / n if n else None
            speed = speed if speed is None else float(Decimal(repr(speed)).quantize(Decimal("0.1"), ROUND_HALF_UP))
            out.append((due, key[0], n, {k: c for k, (c, _) in sorted(kinds.items())}, speed))
            for kind in kinds:
                self.sums.removeKey((due, kind))
            due += self.window_s
        self.due.update((due,))
        self.handle.registerTimer((due + self.window_s) * 1000)
        yield pd.DataFrame(out, columns=["window", "tunnel_id", "vehicles", "counts", "avg_speed_kmh"])

    def close(self) -> None:
        pass


def traffic_windows(events: DataFrame, tunnels: DataFrame, start_ms: int, window_s: int = 60, delay: str = "10 minutes") -> DataFrame:
    """A stream of reports (``REPORT``), one for each tunnel and window from ``start_ms`` on, as ``fusion.traffic_report``.

    ``events`` is a stream of vehicle events with ``at``, their event-time timestamp. Every tunnel of
    ``tunnels`` reports, with zeros where nothing passed; so does any other from its first event on.
    A window closes ``delay`` after its end, in event time.
    """
    rows = events.withWatermark("at", delay).select("at", "tunnel_id", "ts_entry", "direction", "classification", "speed_kmh")
    known = tunnels.select("tunnel_id").distinct().withColumn("known", F.lit(True)).groupBy("tunnel_id")
    return rows.groupBy("tunnel_id").transformWithStateInPandas(TrafficWindows(window_s, start_ms), REPORT, "Append", "EventTime", initialState=known)
