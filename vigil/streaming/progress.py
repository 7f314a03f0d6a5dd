"""What each micro-batch took in and dropped, recorded by a query listener."""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Rows in, and rows dropped by the watermark, by query and batch.

    A batch that runs again after a restart keeps one entry.  Of each query the last
    ``keep`` batches are listed; older ones stay in the totals.
    """

    def __init__(self, keep: int = 1000):
        self._keep, self._lock = keep, threading.Lock()
        self._batches: dict[str, dict[int, tuple[int, int]]] = {}
        self._old: dict[str, tuple[int, int]] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        dropped = sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators)
        with self._lock:
            mine = self._batches.setdefault(str(p.id), {})
            # an idle or closing batch of the same number takes nothing in
            rows, late = mine.get(p.batchId, (0, 0))
            mine[p.batchId] = (max(rows, int(p.numInputRows)), max(late, dropped))
            while len(mine) > self._keep:
                a, b = self._old.get(str(p.id), (0, 0))
                x, y = mine.pop(min(mine))
                self._old[str(p.id)] = (a + x, b + y)

    def onQueryTerminated(self, event):
        with self._lock:
            self._ended.add(str(event.id))

    def batches(self, query) -> dict[int, tuple[int, int]]:
        with self._lock:
            return dict(self._batches.get(str(query.id), {}))

    def totals(self, query) -> tuple[int, int]:
        """(rows in, rows dropped as late) of a query."""
        with self._lock:
            a, b = self._old.get(str(query.id), (0, 0))
            mine = self._batches.get(str(query.id), {}).values()
            return a + sum(x for x, _ in mine), b + sum(y for _, y in mine)

    def ended(self, query) -> bool:
        """Whether the query's last event has arrived; all its progress came before."""
        with self._lock:
            return str(query.id) in self._ended


def record_progress(spark: SparkSession) -> ProgressLog:
    """A log of all streaming queries of the session from now on."""
    log = ProgressLog()
    spark.streams.addListener(log)
    return log
