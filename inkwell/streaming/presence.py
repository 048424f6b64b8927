"""Live presence: one keyed state per instance, transitions fired by timers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ACTIVITY = "service STRING, instanceId STRING, activity_us BIGINT, beat_us BIGINT, last_event STRING"
TRANSITION = T.StructType(
    [
        T.StructField("service", T.StringType()),
        T.StructField("instanceId", T.StringType()),
        T.StructField("liveness", T.StringType()),
        T.StructField("last_activity_us", T.LongType()),
    ]
)


def partial_activity(metrics: DataFrame) -> DataFrame:
    """One row per instance and Arrow batch, so that chatty instances shrink before the shuffle."""

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            # of equal times a SHUTDOWN counts as the later one, in whatever order they come
            pdf = pdf.assign(_down=pdf["event"] == "SHUTDOWN").sort_values(["activity_us", "_down"], kind="stable")
            yield pdf.groupby(["service", "instanceId"], as_index=False, dropna=False).agg(
                activity_us=("activity_us", "max"), beat_us=("beat_us", "max"), last_event=("event", "last")
            ).astype({"beat_us": "Int64"})

    us = F.unix_micros("ts")
    slim = metrics.select(
        "service", "instanceId", us.alias("activity_us"),
        F.when(F.col("event").isin("INIT", "HEARTBEAT"), us).alias("beat_us"), "event",
    )
    return slim.mapInPandas(combine, ACTIVITY)


class PresenceProcessor(StatefulProcessor):
    """Emits a row whenever the liveness class of an instance changes.

    Ages count from the arrival of the last message (processing time), so an instance
    goes Degraded and Offline without any further input.
    """

    def __init__(self, alive_s: float = 30, degraded_s: float = 120):
        self.alive_ms, self.degraded_ms = int(alive_s * 1000), int(degraded_s * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("presence", "liveness STRING, seen_ms BIGINT, activity_us BIGINT")

    def _clear_timers(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        latest, event = -1, None
        for r in rows:
            if (r.activity_us, r.last_event == "SHUTDOWN") > (latest, event == "SHUTDOWN"):
                latest, event = r.activity_us, r.last_event
        old = self.state.get() if self.state.exists() else None
        if old is not None and old[2] > latest:
            latest, event = old[2], None if old[0] != "Stopped" else "SHUTDOWN"
        status = "Stopped" if event == "SHUTDOWN" else "Alive"
        self.state.update((status, now, latest))
        self._clear_timers()
        if status == "Alive":
            self.handle.registerTimer(now + self.alive_ms + 1)
        if old is None or old[0] != status:
            yield Row(service=key[0], instanceId=key[1], liveness=status, last_activity_us=latest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.state.exists():
            return
        status, seen, latest = self.state.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        new = "Offline" if now - seen > self.degraded_ms else "Degraded"
        if new == "Degraded":
            self.handle.registerTimer(seen + self.degraded_ms + 1)
        if new != status:
            self.state.update((new, seen, latest))
            yield Row(service=key[0], instanceId=key[1], liveness=new, last_activity_us=latest)

    def close(self) -> None:
        pass


def live_presence(metrics: DataFrame, alive_s: float = 30, degraded_s: float = 120) -> DataFrame:
    """Liveness transitions of a stream of monitoring messages (needs the RocksDB state store)."""
    return (
        partial_activity(metrics)
        .groupBy("service", "instanceId")
        .transformWithState(
            statefulProcessor=PresenceProcessor(alive_s, degraded_s),
            outputStructType=TRANSITION,
            outputMode="Update",
            timeMode="ProcessingTime",
        )
    )
