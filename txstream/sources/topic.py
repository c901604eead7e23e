"""Keyed, partitioned topic tables.

A topic is a Parquet directory partitioned by ``partition`` (``partition=<p>/``
sub-directories); a record's partition is ``partition_of(key, n)``, so one key
always lands in one partition.  Writing needs no shuffle: every task writes its
rows into the partition directories they belong to.

Reading is a streaming file scan.  A consumer group is a checkpoint folder: it
remembers which files it has taken.  ``start="earliest"`` reads everything;
``start="latest"`` reads only files that appear after the group was first
created -- the set of files present at that moment is stored next to the
group's checkpoint as a small table and anti-joined away on ``_metadata.file_path``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from txstream.functions.partitioning import partition_of
from txstream.sources import groups
from txstream.sources.fs import mkdirs, path_exists

create_group = groups.create_group

PARTITION = "partition"
DEFAULT_PARTITIONS = 4  # fixed value: partition count of the main and dead-letter topics
QUARANTINE_PARTITION = -1   # reserved partition for records that could not be decoded


def assign_partition(df: DataFrame, key: str, num_partitions: int = DEFAULT_PARTITIONS) -> DataFrame:
    return df.withColumn(PARTITION, partition_of(key, num_partitions))


def topic_schema(record: T.StructType) -> T.StructType:
    return T.StructType(list(record.fields) + [T.StructField(PARTITION, T.LongType())])


def append(df: DataFrame, topic: str, key: str, num_partitions: int = DEFAULT_PARTITIONS) -> None:
    """Batch append of a frame to a batch-written topic."""
    if path_exists(spark_of(df), f"{topic}/_spark_metadata"):
        raise ValueError(f"{topic} is written by a stream; append through topic_writer")
    assign_partition(df, key, num_partitions).write.mode("append") \
        .partitionBy(PARTITION).parquet(topic)


def topic_writer(stream: DataFrame, topic: str, key: str, checkpoint: str,
                 num_partitions: int = DEFAULT_PARTITIONS) -> DataStreamWriter:
    """Exactly-once streaming append (file sink + its metadata log)."""
    return (assign_partition(stream, key, num_partitions).writeStream
            .format("parquet").partitionBy(PARTITION)
            .option("path", topic).option("checkpointLocation", checkpoint))


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def scan(spark: SparkSession, topic: str, record: T.StructType, group: str | None = None,
         start: str = "earliest", stream: bool = True, partitions=None,
         max_files_per_trigger: int | None = None,
         max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Read a topic; rows carry their ``partition``.

    ``partitions`` restricts the read to some partitions (pruned at listing);
    by default the reserved quarantine partition is skipped the same way.
    For streams ``group`` is required and names the checkpoint folder to use;
    ``max_files_per_trigger`` / ``max_bytes_per_trigger`` bound a micro-batch.
    """
    schema = topic_schema(record)
    if not stream:
        df = spark.read.schema(schema).parquet(topic)
    else:
        if group is None:
            raise ValueError("a streaming scan needs a consumer group (checkpoint folder)")
        if not path_exists(spark, topic):
            mkdirs(spark, topic)           # subscribing before the first write is fine
        groups.create_group(spark, topic, group, start)
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        if max_bytes_per_trigger:
            reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
        df = reader.parquet(topic)
        if start == "latest":
            df = groups.skip_group_start(spark, df, group)
    if partitions is not None:
        df = df.filter(F.col(PARTITION).isin(list(partitions)))
    else:
        df = df.filter(F.col(PARTITION) >= 0)
    return df
