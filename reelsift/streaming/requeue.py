"""Re-queueing by state timeouts: a release comes back when its rest is over, without the table being scanned again.

The batch queues (:mod:`operators.queue`) filter the whole table against a clock. Here each release keeps a few numbers of state, and
timers in event time wake it: after ``recheck_days`` for the lookup queue, after ``min_age_minutes`` for the retry queue, after MISS_DAYS for a remembered
miss.  The clock is the stream's watermark.  State and timers live in RocksDB, so their number isn't bounded by memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.ids import MISS_DAYS, any_id, missing_any_id

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY, MINUTE = 86_400_000, 60_000
#: The queues, by number; a row of the state has the millisecond at which each is due, -1 where it never is.
QUEUES = ("enrich", "retry", "miss")
_STATE = StructType([StructField(q, LongType()) for q in QUEUES])
_OUT = "id long, queue string, due_at long"


def events(rows: DataFrame, at: Column, *, missed_at: Column | None = None) -> DataFrame:
    """(id, at, checked, attempts, lacks, none, missed) of releases as they are from ``at`` on; times in milliseconds, null where never.

    missed_at: when the row's lookup was remembered as a miss."""
    ms = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / 1000).cast("long")
    return rows.select("id", at.cast("timestamp").alias("at"), ms(F.col("ids_checked_at")).alias("checked"), F.coalesce("ids_attempts", F.lit(0)).cast("int").alias("attempts"), missing_any_id().alias("lacks"), (~any_id()).alias("none"), (ms(missed_at) if missed_at is not None else F.lit(None).cast("long")).alias("missed"))


class Requeue(StatefulProcessor):
    """One release: what it waits for."""

    def __init__(self, recheck_days: int, min_age_minutes: int, max_attempts: int, miss_days: int):
        self.recheck, self.rest, self.attempts, self.miss = recheck_days * DAY, min_age_minutes * MINUTE, max_attempts, miss_days * DAY

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", _STATE)

    def _dues(self, e) -> list[int]:
        """When each queue wants the release: 0 for at once, -1 for never.  A rest is over strictly after its last moment, a miss with it."""
        after = lambda t, rest: 0 if pd.isna(t) else int(t) + rest + 1
        return [after(e.checked, self.recheck) if e.lacks else -1, after(e.checked, self.rest) if e.none and e.attempts < self.attempts else -1, -1 if pd.isna(e.missed) else int(e.missed) + self.miss]

    def _told(self, key, now: int, dues: list[int]) -> tuple[pd.DataFrame, list[int]]:
        """Rows of the queues that are due, and what is left; the earliest of it gets the timer."""
        out = [(key[0], q, d) for q, d in zip(QUEUES, dues, strict=True) if 0 <= d <= now]
        left = [-1 if 0 <= d <= now else d for d in dues]
        if waiting := [d for d in left if d >= 0]:
            self.handle.registerTimer(min(waiting))
        return pd.DataFrame(out, columns=["id", "queue", "due_at"]), left

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = None
        for frame in rows:
            # what a release is now is its latest event
            for e in frame.itertuples(index=False):
                if last is None or e.at >= last.at:
                    last = e
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        told, left = self._told(key, max(timerValues.getCurrentWatermarkInMs(), 0), self._dues(last))
        self.due.update(tuple(left))
        yield told

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.due.exists():
            return
        told, left = self._told(key, max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()), [int(x) for x in self.due.get()])
        self.due.update(tuple(left))
        yield told

    def close(self) -> None:
        pass


def use_state_store(spark: SparkSession) -> None:
    """State with timers needs RocksDB as the session's state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def requeued(stream: DataFrame, *, recheck_days: int = 45, min_age_minutes: int = 60, max_attempts: int = 4, miss_days: int = MISS_DAYS, late: str = "0 seconds") -> DataFrame:
    """(id, queue, due_at): each release of a stream of :func:`events` when a queue is due for it, once after each of its events.

    queue: "enrich" (lacks an identifier, rested), "retry" (has none, attempts left, rested), "miss" (a remembered miss has grown old).  due_at: milliseconds, 0 for what was never checked.  Rows
    without an id or a time are ignored; a later event replaces what was waited for."""
    use_state_store(stream.sparkSession)
    keyed = stream.where("id is not null and at is not null").withWatermark("at", late).groupBy("id")
    return keyed.transformWithStateInPandas(statefulProcessor=Requeue(recheck_days, min_age_minutes, max_attempts, miss_days), outputStructType=_OUT, outputMode="append", timeMode="eventTime")
