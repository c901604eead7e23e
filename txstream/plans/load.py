"""Load-test layout: one session writes a topic and reads it back.

* writer query: payload events keyed by the text of their id -> topic with
  ``num_partitions`` partitions;
* reader query: a consumer group on that topic; each row gets its processing
  time and lag (processing time - event time), a running event counter is
  observed on the stream, and the lag samples land in a metrics table
  ``(partition, id, timestamp, processed_at, lag)``.

Histograms, p99 and rates are then ordinary batch (or streaming) queries over
the metrics table -- see ``txstream.operators.metrics``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txstream import schemas
from txstream.functions.clock import lag_ms, now_ms
from txstream.operators.metrics import observe_counter
from txstream.sources import topic as topics

COUNTER = "event_counter"


def load_writers(spark: SparkSession, events: DataFrame, root: str, num_partitions: int = 1):
    """Return ``(writer, reader)`` stream writers; start the writer first."""
    topic = f"{root}/topic"
    writer = topics.topic_writer(events, topic, "id", f"{root}/_ck/writer", num_partitions)
    return writer, lambda: _reader(spark, topic, root)


def _reader(spark: SparkSession, topic: str, root: str):
    group = f"{root}/_ck/group"
    s = topics.scan(spark, topic, schemas.PAYLOAD_EVENT, group=group, start="earliest")
    s = observe_counter(s, COUNTER)
    samples = s.select("partition", "id", "timestamp", now_ms().alias("processed_at"),
                       lag_ms(now_ms()).alias("lag"))
    return (samples.writeStream.format("parquet").option("path", f"{root}/lag")
            .option("checkpointLocation", group))


def read_samples(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/lag")
