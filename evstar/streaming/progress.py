"""Counting what a bounded streaming query read."""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class RowCounter(StreamingQueryListener):
    """Sums the input rows of every micro-batch of the queries it hears of
    (a query object itself only remembers its last batches)."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        run_id = str(event.progress.runId)
        self.rows[run_id] = self.rows.get(run_id, 0) + int(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def drained(self, query: StreamingQuery, wait_s: float = 60.0) -> int:
        """Rows of all batches of ``query``, once it has ended (its progress
        events come before its end)."""
        query.awaitTermination()
        run_id = str(query.runId)
        if not self._end(run_id).wait(wait_s):
            raise TimeoutError("the end of the query was not reported")
        return self.rows.get(run_id, 0)
