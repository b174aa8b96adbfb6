"""Stalls as they happen: keyed state with event-time timers.

Events come in any order. Those of a worker wait in its state until the watermark has passed them and are then
taken in order of time, so the result is that of a batch over all events that were not too late. A timer stands
where the earliest waiting event lies, and another where the present wait becomes a stall, so that a worker that
falls silent is reported by the clock of the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from deslinde import constants as C
from deslinde.streaming.progress import LATE

WAITING = "us bigint, event_id bigint, counter bigint"
PROGRESS = "counter bigint, us bigint, told boolean"
STALL = "worker bigint, counter bigint, stalled_from_us bigint"
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class StallWatch(StatefulProcessor):
    """Emits (worker, counter, stalled_from_us) once for every wait of more than ``seconds``."""

    def __init__(self, seconds: int):
        self.limit = seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.progress = handle.getValueState("progress", PROGRESS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            self.waiting.appendList([tuple(int(v) for v in r) for r in batch[["us", "event_id", "counter"]].itertuples(index=False)])
        yield from self._advance(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, timerValues)

    def _advance(self, key, timerValues) -> Iterator[pd.DataFrame]:
        """Take the events that the watermark has passed, report waits that have become too long, set the timers anew."""
        now = timerValues.getCurrentWatermarkInMs() * 1000
        events = sorted(tuple(e) for e in self.waiting.get()) if self.waiting.exists() else []
        passed, later = [e for e in events if e[0] <= now], [e for e in events if e[0] > now]
        counter, since, told = self.progress.get() if self.progress.exists() else (0, None, False)
        stalls = []
        for us, _, value in passed:
            if since is None:
                since = us
            if not told and us - since > self.limit:
                stalls.append((counter, since))
                told = True
            if value > counter:
                counter, since, told = value, us, False
        if since is not None and not told and now - since > self.limit:
            stalls.append((counter, since))
            told = True
        if passed:
            self.waiting.clear()
            if later:
                self.waiting.put(later)
        if since is not None:
            self.progress.update((counter, since, told))
        wanted = {e[0] // 1000 + 1 for e in later[:1]}
        if since is not None and not told:
            wanted.add((since + self.limit) // 1000 + 1)
        for timer in list(self.handle.listTimers()):
            if timer not in wanted:
                self.handle.deleteTimer(timer)
        for at in wanted:
            self.handle.registerTimer(at)
        if stalls:
            yield pd.DataFrame({"worker": int(key[0]), "counter": [s[0] for s in stalls], "stalled_from_us": [s[1] for s in stalls]})

    def close(self) -> None:
        pass


def watch_stalls(events: DataFrame, seconds: int = C.STALL_SECONDS, late: str = LATE) -> DataFrame:
    """(worker, counter, stalled_from) for every wait of more than ``seconds``, from a stream (worker, ts, event_id, counter).

    A worker's clock starts with its first event at a counter of 0. Events later than ``late`` are dropped by the watermark
    and counted by `late_rows`. The session needs the RocksDB state store (`with_rocksdb`).
    """
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    rows = timed.select(F.col("worker").cast("bigint").alias("worker"), "ts", F.unix_micros("ts").alias("us"), F.col("event_id").cast("bigint").alias("event_id"), F.col("counter").cast("bigint").alias("counter"))
    found = rows.groupBy("worker").transformWithStateInPandas(StallWatch(seconds), STALL, "Append", "EventTime")
    return found.select("worker", "counter", F.timestamp_micros("stalled_from_us").alias("stalled_from"))


def with_rocksdb(spark: SparkSession) -> SparkSession:
    """Keyed state with timers lives in RocksDB."""
    spark.conf.set(*STORE)
    return spark


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped in the query's recent batches."""
    return sum(state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"])
