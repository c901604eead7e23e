"""Message log: keyed JSON records, as a ``kafka`` topic or a file-backed log.

The file-backed log is a Parquet directory of ``key BINARY, value BINARY`` (plus
any pass-through columns) written by a streaming file sink; it stands in for a
broker where none is reachable.  ``format="kafka"`` switches both ends to
Spark's own connector (its jar must be on the class path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from txstream import schemas
from txstream.functions.codec import decode_json, to_log_record
from txstream.sources import groups


def log_writer(records: DataFrame, path_or_topic: str, checkpoint: str,
               fmt: str = "parquet", kafka_options: dict | None = None) -> DataStreamWriter:
    """Streaming writer appending log records (``key``, ``value``) at least once."""
    w = records.writeStream.option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        w = w.format("kafka").option("topic", path_or_topic)
        for k, v in (kafka_options or {}).items():
            w = w.option(k, v)
        return w
    return w.format("parquet").option("path", path_or_topic)


def read_log(spark: SparkSession, path_or_topic: str, fmt: str = "parquet",
             stream: bool = True, starting: str = "earliest",
             kafka_options: dict | None = None, extra_fields=(),
             group: str | None = None, max_files_per_trigger: int | None = None,
             max_bytes_per_trigger: str | None = None,
             max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Scan the log from the earliest record (default) as a stream or a batch.

    ``starting="latest"`` on the file log needs ``group`` (the checkpoint folder
    of the reading query) to remember which records existed at its first start.
    The ``max_*_per_trigger`` arguments bound a micro-batch (files and bytes of the file
    log, records of the broker).
    """
    if fmt == "kafka":
        r = (spark.readStream if stream else spark.read).format("kafka")
        r = r.option("subscribe", path_or_topic).option("startingOffsets", starting)
        if stream and max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        for k, v in (kafka_options or {}).items():
            r = r.option(k, v)
        return r.load()
    schema = T.StructType(list(extra_fields) + list(schemas.LOG_RECORD.fields))
    if not stream:
        return spark.read.schema(schema).parquet(path_or_topic)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    df = reader.parquet(path_or_topic)
    if starting == "latest":
        if group is None:
            raise ValueError("starting='latest' on the file log needs a group")
        groups.create_group(spark, path_or_topic, group, "latest")
        df = groups.skip_group_start(spark, df, group)
    return df


def scan_values(log: DataFrame, schema: T.StructType = schemas.TRANSACTION, keep=()):
    """Value-only decode: key and metadata dropped.  Returns ``(decoded, quarantine)``."""
    return decode_json(log.withColumn("value", F.col("value").cast("string")), schema,
                       "value", keep)


__all__ = ["log_writer", "read_log", "scan_values", "to_log_record"]
