"""One buffer per event type, flushed at a number of rows or an age (T-2).

Keyed stateful processing: the rows of a type wait in list state; a full
buffer leaves at once, the rest when the timer of its first row fires. A
type is dealt over ``LANES`` buffers by the source partition, so that a type
with a third of all messages is not one task; each lane follows the rule, so
no flush of a type is over the limit or late.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

ROWS_PER_FLUSH = 500
MAX_AGE_MS = 60_000
LANES = 8
# numbers and times wait as text, which keeps nulls as they are
_MESSAGE = "key string, value binary, partition string, offset string, timestamp string"
_FIELDS = ["key", "value", "partition", "offset", "timestamp"]
FLUSHED = f"{_MESSAGE}, lane int, flush long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TypeBuffer(StatefulProcessor):
    """Rows of one (type, lane): ``flush`` numbers the flushes from 1."""

    def __init__(self, rows: int, max_age_ms: int) -> None:
        self.limit, self.max_age_ms = rows, max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _MESSAGE)
        self.state = handle.getValueState("state", "n long, flush long")

    def _out(self, rows: list[tuple], key: tuple, flush: int) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=_FIELDS)
        return out.assign(lane=key[1], flush=flush)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        n, flush = self.state.get() if self.state.exists() else (0, 0)
        began = n > 0
        for frame in rows:
            new = list(frame[_FIELDS].itertuples(index=False, name=None))
            while n + len(new) >= self.limit:
                take = self.limit - n
                held = [tuple(r) for r in self.waiting.get()] if n else []
                if n:
                    self.waiting.clear()
                flush, n = flush + 1, 0
                yield self._out(held + new[:take], key, flush)
                new, began = new[take:], False
                self._drop_timers()
            if new:
                self.waiting.appendList(new)
                n += len(new)
                if not began:
                    began = True
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.max_age_ms)
        self.state.update((n, flush))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, flush = self.state.get() if self.state.exists() else (0, 0)
        if n:
            rows = [tuple(r) for r in self.waiting.get()]
            self.waiting.clear()
            self.state.update((0, flush + 1))
            yield self._out(rows, key, flush + 1)

    def _drop_timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def close(self) -> None:
        """Nothing is held outside the state."""


def buffered(messages: DataFrame, rows: int = ROWS_PER_FLUSH, max_age_ms: int = MAX_AGE_MS, lanes: int = LANES) -> DataFrame:
    """The messages (Kafka's columns) in flushes of their type. A message
    without a key waits in a buffer of its own. Needs the RocksDB state
    store."""
    typed = messages.select(
        F.col("key").cast("string").alias("key"),
        "value",
        F.col("partition").cast("string").alias("partition"),
        F.col("offset").cast("string").alias("offset"),
        F.unix_micros("timestamp").cast("string").alias("timestamp"),
        F.coalesce(F.col("key").cast("string"), F.lit("")).alias("type"),
        F.pmod(F.coalesce(F.col("partition"), F.lit(0)), F.lit(lanes)).cast("int").alias("lane"),
    )
    flushed = typed.groupBy("type", "lane").transformWithStateInPandas(
        statefulProcessor=TypeBuffer(rows, max_age_ms),
        outputStructType=FLUSHED,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
    return flushed.select(
        "key",
        "value",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.timestamp_micros(F.col("timestamp").cast("long")).alias("timestamp"),
        "lane",
        "flush",
    )


def _batches(query: StreamingQuery) -> list[tuple[dt.datetime, int]]:
    """Start and input rows of the last batches."""
    return [(dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")), p.numInputRows) for p in query.recentProgress]


def drain_buffers(query: StreamingQuery, max_age_ms: int, wait_s: float = 600.0) -> None:
    """End a bounded run: once the source is read to its end and a batch has
    begun after the last timer was due, every buffer is empty; then stop."""
    age, until = dt.timedelta(milliseconds=max_age_ms), time.monotonic() + wait_s
    last_input: dt.datetime | None = None
    try:
        while time.monotonic() < until:
            if query.exception() is not None:
                raise query.exception()
            batches = _batches(query)
            last_input = max([at for at, rows in batches if rows] + ([last_input] if last_input else []), default=None)
            if batches and batches[-1][0] > (last_input or batches[0][0]) + age:
                return
            time.sleep(0.1)
        raise TimeoutError("the buffers were not drained in time")
    finally:
        query.stop()
