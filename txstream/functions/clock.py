"""Event-time helpers over epoch-millisecond BIGINT columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def now_ms() -> Column:
    """Wall clock in epoch ms, fixed within one query / micro-batch."""
    return F.unix_millis(F.current_timestamp())


def event_time(ms: str | Column = "timestamp") -> Column:
    """TIMESTAMP view of an epoch-ms column (for windows and watermarks)."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(ms)


def lag_ms(processed_at_ms: Column, event_ms: str | Column = "timestamp") -> Column:
    """Event lag: processing time minus event time, in ms."""
    event_ms = F.col(event_ms) if isinstance(event_ms, str) else event_ms
    return processed_at_ms - event_ms


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_ms(ts: str | Column) -> Column:
    """Epoch ms of a TIMESTAMP_NTZ read as UTC (truncating), independent of session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), ts)


def ms_to_ntz(ms: str | Column) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ of an epoch-ms column, independent of session zone."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_add("MILLISECOND", ms, _epoch_ntz())
