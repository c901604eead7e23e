"""Exactly one row a key out of an at-least-once stream.

Two steps: ``dropDuplicatesWithinWatermark`` removes the repeats that come within ``delay`` of each
other -- its state is bounded by the watermark -- and the keyed store behind it (``insert`` of
``operators.keyed_store``) removes those that come later, exactly, at the cost of a lookup in the runs
that may hold a batch's keys.  Spark drops rows that are later than the watermark, so this is by default
one of the time of arrival, of which no row is late; it only tells when a key may be forgotten.  Of a
key's rows the first to arrive stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from txstream.operators import keyed_store


def without_recent_repeats(stream: DataFrame, key: str, delay: str = "10 minutes",
                           arrival: Column | None = None) -> DataFrame:
    """The stream without repeats of a key within ``delay`` of ``arrival`` (default: now)."""
    at = F.current_timestamp() if arrival is None else arrival
    return (stream.withColumn("_at", at).withWatermark("_at", delay)
                  .dropDuplicatesWithinWatermark([key]).drop("_at"))


def unique_writer(stream: DataFrame, key: str, store: str, checkpoint: str, time_ms: str = "timestamp",
                  delay: str = "10 minutes", fan_out: int = keyed_store.FAN_OUT,
                  background: bool = False, arrival: Column | None = None) -> DataStreamWriter:
    """Write each key's first row to a keyed store (read it with ``keyed_store.read``)."""
    columns = stream.columns

    def each(batch: DataFrame, batch_id: int) -> None:
        keyed_store.insert(batch, store, batch_id, key=key, order=(time_ms,), columns=columns, writer=checkpoint)
        if background:
            keyed_store.merge_later(batch.sparkSession, store, fan_out)
        else:
            while keyed_store.merge(batch.sparkSession, store, fan_out) is not None:
                pass
    return (without_recent_repeats(stream, key, delay, arrival).writeStream
            .option("checkpointLocation", checkpoint).foreachBatch(each))
