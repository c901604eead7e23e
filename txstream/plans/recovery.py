"""Recovery layout: producer -> single-partition topic -> processor -> text lines.

The producer appends sequence events (payload = text of id) to a topic with one
partition keyed by id; the processor reads it with its own consumer group and
writes one text line per event into hourly bucket folders.  ``delivered``
parses the lines back, so the audits of ``txstream.operators.audit`` run on
what the sink really holds: after any number of restarts the missing,
duplicated and altered sets must be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txstream import schemas
from txstream.functions.codec import parse_sequence_line, row_to_line
from txstream.sources import topic as topics
from txstream.streaming.sinks import text_writer

RECOVERY_PARTITIONS = 1  # fixed value: the recovery topic has one partition


def producer(events: DataFrame, root: str):
    return topics.topic_writer(events, f"{root}/topic", "id", f"{root}/_ck/producer",
                               RECOVERY_PARTITIONS)


def processor(spark: SparkSession, root: str, start: str = "earliest"):
    group = f"{root}/_ck/processor"
    s = topics.scan(spark, f"{root}/topic", schemas.SEQUENCE_EVENT, group=group, start=start)
    return text_writer(s, row_to_line("sequence_event"), f"{root}/lines", group)


def delivered(spark: SparkSession, root: str) -> DataFrame:
    lines = spark.read.schema("value string, bucket string").text(f"{root}/lines")
    return lines.select(*parse_sequence_line("value"))


def summary(produced: DataFrame, got: DataFrame, key: str = "id") -> DataFrame:
    """One row: produced, delivered, missing, duplicated and altered counts.

    Delivered rows are first reduced to one row per id (copies, altered copies)
    by a partial aggregation, so the join below has unique keys on both sides.
    """
    per_id = got.groupBy(key).agg(
        F.count(F.lit(1)).alias("_copies"),
        F.count_if(~F.col("payload").eqNullSafe(F.col(key).cast("string"))).alias("_altered"))
    both = produced.select(key, F.lit(1).alias("_produced")).join(per_id, key, "full")
    return both.agg(
        F.count("_produced").alias("produced"),
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("bigint").alias("delivered"),
        F.count_if(F.col("_produced").isNotNull() & F.col("_copies").isNull()).alias("missing"),
        F.count_if(F.col("_copies") > 1).alias("duplicated"),
        F.coalesce(F.sum("_altered"), F.lit(0)).cast("bigint").alias("altered"))
