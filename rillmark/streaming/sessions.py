"""Sessions of a stream that end after a pause or at an event of a given type.

A session window cannot end early, so the state is kept by hand: per user the events that
the watermark has not passed, and the running totals of the open session. Events are taken
up in order of (time, id) once the watermark is past them, so the order of arrival within
the watermark does not matter. One event-time timer per user wakes it when there is
something to take up or a pause is over. State is in RocksDB, a row per user and arrival.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Waiting events in one row of the state.
PACK = 1000
CLOSED = "user_id string, first bigint, last bigint, events bigint, ended_by string"


class SessionsUntil(StatefulProcessor):
    """Closed sessions of one user. Times are microseconds; ``gap`` too."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("arrived", "at array<bigint>, id array<string>, ends array<boolean>")
        self.open = handle.getValueState("open", "first bigint, last bigint, events bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = [(row.at, row.event_id, row.ends) for row in rows]
        self.waiting.appendList(_packed(came))
        passed = timerValues.getCurrentWatermarkInMs()
        timers = list(self.handle.listTimers())
        wake = _millis(min(at for at, _, _ in came))
        if min([wake, *timers]) <= passed:
            yield from self._advance(key, passed, timers)
        elif not timers or wake < min(timers):  # nothing to take up yet: what was stored is not read
            self._wait(wake, timers)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, timerValues.getCurrentWatermarkInMs(), [])  # the caller deletes the timer that woke it

    def close(self) -> None:
        pass

    def _wait(self, wake: int, timers: list[int]) -> None:
        for timer in timers:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(wake)

    def _advance(self, key, watermark: int, timers: list[int]) -> Iterator[Row]:
        """Take up what the watermark has passed, then wait for the next event or the end of the pause."""
        passed = watermark * 1000
        waiting = sorted(row for pack in self.waiting.get() for row in zip(*pack))
        ready = [row for row in waiting if row[0] <= passed]
        before = self.open.get()
        current = before = tuple(before) if before is not None else None
        closed = []
        for at, _, ends in ready:
            if current and at > current[1] + self.gap:
                closed.append((*current, "pause"))
                current = None
            current = (current[0], at, current[2] + 1) if current else (at, at, 1)
            if ends:
                closed.append((*current, "event"))
                current = None
        if current and passed >= current[1] + self.gap:  # events to come are later than the watermark
            closed.append((*current, "pause"))
            current = None
        if current and current != before:
            self.open.update(current)
        elif before and not current:
            self.open.clear()
        later = waiting[len(ready) :]
        if ready:
            self.waiting.put(_packed(later)) if later else self.waiting.clear()
        wake = ([later[0][0]] if later else []) + ([current[1] + self.gap] if current else [])
        if wake:
            self._wait(_millis(min(wake)), timers)
        else:
            for timer in timers:
                self.handle.deleteTimer(timer)
        for first, last, events, ended_by in closed:
            yield Row(user_id=key[0], first=first, last=last, events=events, ended_by=ended_by)


def _packed(events: list[tuple]) -> list[tuple]:
    """Events as columns, ``PACK`` to a state row: a state row costs far more than what it holds."""
    return [tuple(list(column) for column in zip(*events[k : k + PACK])) for k in range(0, len(events), PACK)]


def _millis(micros: int) -> int:
    """The first millisecond at or behind a time."""
    return -(-micros // 1000)


def sessions_until(events: DataFrame, gap: timedelta, end_on: str, ts: str = "event_ts", watermark: str = "1 hour") -> DataFrame:
    """Closed sessions of every user: (user_id, session_start, last_event_ts, events, ended_by).

    A session ends behind an event of type ``end_on`` (``ended_by`` event) or after a pause
    longer than ``gap`` (pause). Events behind the watermark are dropped and counted by the
    query's progress; rows without a user or time belong to no session. Needs the RocksDB
    state store while the query starts, see ``rocks_state``.
    """
    rows = events.where(F.col("user_id").isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, watermark)
    ends = F.coalesce(F.col("event_type") == end_on, F.lit(False))
    rows = rows.select("user_id", ts, F.unix_micros(ts).alias("at"), F.col("event_id").cast("string").alias("event_id"), ends.alias("ends"))
    step = SessionsUntil(int(gap / timedelta(microseconds=1)))
    closed = rows.groupBy("user_id").transformWithState(step, CLOSED, "Append", "EventTime")
    moments = {"session_start": F.timestamp_micros("first"), "last_event_ts": F.timestamp_micros("last")}
    return closed.select("user_id", *[moment.alias(name) for name, moment in moments.items()], "events", "ended_by")


@contextmanager
def rocks_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def dropped_rows(query) -> int:
    """Rows that a query has dropped because they came behind its watermark."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
