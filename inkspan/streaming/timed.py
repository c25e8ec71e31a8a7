"""Retries with a waiting time: a failed message is hidden for a while and then tried again.

Messages are keyed by file. What waits is state of its file, with the time at which
the message is visible again; an event-time timer of the file, set for the first of them,
brings back all that are due when the watermark gets there. A success or the last attempt closes its state. Needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from inkspan.operators.routing import DEAD_LETTER, DONE, MAX_ATTEMPTS, RETRY

# Fixed value: seconds for which a failed message is hidden.
VISIBILITY = 30
LATENESS = "10 minutes"
# Rows of one frame of outcomes.
ROWS = 10_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class _Deliveries(StatefulProcessor):
    """Tries each message of a file, and again after the waiting time while it fails."""

    def __init__(self, process, key: str, message_id: str, ts: str, max_attempts: int, visibility: int):
        self.process, self.key, self.message_id, self.ts = process, key, message_id, ts
        self.max_attempts, self.visibility = max_attempts, visibility

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "id string", "attempt int, due long, body string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            times = (pd.to_datetime(frame[self.ts], utc=True).astype("int64") // 10**6).tolist()
            found, again = [], {}
            for name, at, body in zip(frame[self.message_id], times, frame["body"], strict=True):
                self._deliver(str(name), body, 1, at, now, found, again)
            self._wait(again)
            yield self._rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All messages of the file whose time has come, whichever of them the timer was set for."""
        now, found, again, gone, least = timerValues.getCurrentWatermarkInMs(), [], {}, [], None
        for (name,), (attempt, at, body) in self.waiting.iterator():
            if at > now:
                least = at if least is None else min(least, at)
                continue
            gone.append(name)
            self._deliver(name, body, attempt, at, now, found, again)
            if len(found) >= ROWS:
                yield self._rows(key, found)
                found = []
        if gone and least is None:
            self.waiting.clear()
        else:
            for name in gone:
                self.waiting.removeKey((name,))
        self._wait(again, least)
        if found:
            yield self._rows(key, found)

    def _deliver(self, name: str, body: str, attempt: int, at: int, now: int, found: list, again: dict) -> None:
        """The attempts from this one on whose time has come; the next one is to wait."""
        while True:
            route = DONE if self.process(body, attempt) else DEAD_LETTER if attempt >= self.max_attempts else RETRY
            found.append((name, attempt, at, route))
            if route != RETRY:
                return
            attempt, at = attempt + 1, at + 1000 * self.visibility
            if at > now:
                again[name] = (attempt, at, body)
                return

    def _wait(self, again: dict, least: int | None = None) -> None:
        """Keep what waits as state, with one timer for the first of it to be due."""
        for name, value in again.items():
            self.waiting.updateValue((name,), value)
        due = [at for _, at, _ in again.values()] + ([] if least is None else [least])
        if due:
            self.handle.registerTimer(min(due))

    def _rows(self, key, found: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(found, columns=[self.message_id, "attempt", "at", "route"])
        frame["at"] = pd.to_datetime(frame["at"], unit="ms")
        frame.insert(0, self.key, key[0])
        return frame

    def close(self) -> None:
        pass


def timed_retries(
    messages: DataFrame,
    process: Callable[[str, int], bool],
    key: str,
    message_id: str = "message_id",
    ts: str = "ts",
    max_attempts: int = MAX_ATTEMPTS,
    visibility: int = VISIBILITY,
    lateness: str = LATENESS,
) -> DataFrame:
    """key, message id, attempt, at, route: every delivery of a stream of (key, id, ts, body).

    ``process`` takes body and attempt and tells whether it succeeded. A failed attempt
    is repeated ``visibility`` seconds later, in the time of the messages, up to
    ``max_attempts``; the last failure is a dead letter. A message is known by its id
    within its key, as text. State holds waiting messages only. Time goes on with the
    latest message less ``lateness``, which must cover the longest delay of the queue:
    Spark drops what comes later than that. Run it under ``rocksdb``.
    """
    fields = [
        messages.schema[key], T.StructField(message_id, T.StringType()), T.StructField("attempt", T.IntegerType()),
        T.StructField("at", T.TimestampType()), T.StructField("route", T.StringType()),
    ]
    return (
        messages.select(key, message_id, ts, "body").withWatermark(ts, lateness).groupBy(key)
        .transformWithStateInPandas(
            _Deliveries(process, key, message_id, ts, max_attempts, visibility),
            T.StructType(fields), "Append", "EventTime",
        )
    )


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that timers need, for the streams started inside."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)
