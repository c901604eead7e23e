"""Running streaming queries to completion (tests, backfills, bench)."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def run_available_now(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Process everything available now in one or more micro-batches, then stop."""
    q = writer.trigger(availableNow=True).start()
    finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if finished is False:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def run_all_available_now(writers, timeout_s: float | None = None) -> list[StreamingQuery]:
    """Start independent ``availableNow`` queries together and wait for all of them."""
    queries = [w.trigger(availableNow=True).start() for w in writers]
    for q in queries:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if finished is False:
            for other in queries:
                other.stop()
            raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return queries


def rows_dropped_by_watermark(q: StreamingQuery, reports: list | None = None) -> int:
    """Late input the query's stateful operators dropped, over ``reports`` (all of them
    from ``streaming.progress``; by default the latest ones, ``recentProgress``).

    Spark counts what reaches the state store: after map-side partial
    aggregation that is one row per late window (and task), not per raw row.
    Lateness is judged against the previous micro-batch's watermark.
    """
    return sum(int(op.numRowsDroppedByWatermark) for p in (q.recentProgress if reports is None else reports)
               for op in p.stateOperators)
