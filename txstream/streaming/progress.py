"""Progress of streaming queries, gathered by a listener.

``query.recentProgress`` holds the latest reports only; a listener sees every one.
Reports are kept per run and batch, so a report delivered twice counts once.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """All progress reports of the queries of a session, by run id and batch id."""

    def __init__(self):
        self._reports: dict[str, dict[int, object]] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            self._reports.setdefault(str(p.runId), {})[p.batchId] = p

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def so_far(self, q: StreamingQuery) -> list:
        """The reports of a query that have arrived until now, in batch order."""
        with self._lock:
            return [p for _, p in sorted(self._reports.get(str(q.runId), {}).items())]

    def reports(self, q: StreamingQuery, timeout_s: float = 60) -> list:
        """Every report of an ended query in batch order (waits for the listener's queue)."""
        if not q.isActive and not self._event(str(q.runId)).wait(timeout_s):
            raise TimeoutError(f"no end report of stream {q.name or q.id}")
        return self.so_far(q)


def run_logged(spark: SparkSession, writer: DataStreamWriter) -> tuple[StreamingQuery, list]:
    """Run a stream over what is available now; returns it and all its progress reports."""
    from txstream.streaming.runner import run_available_now

    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        q = run_available_now(writer)
        return q, log.reports(q)
    finally:
        spark.streams.removeListener(log)


def observed_total(reports: list, name: str, field: str = "events") -> int:
    """Sum of an observed metric over all batches."""
    return sum(int(p.observedMetrics[name][field]) for p in reports if name in p.observedMetrics)


def batch_durations_ms(reports: list) -> list[int]:
    """Trigger durations of the micro-batches that had input."""
    return [int(p.durationMs.get("triggerExecution", 0)) for p in reports if p.numInputRows > 0]
