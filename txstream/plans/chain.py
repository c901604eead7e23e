"""The chained streaming jobs: generate -> log -> topic -> process.

Three independent streaming queries joined only by the tables between them,
each with its own checkpoint:

1. ``log_stage``     transactions -> keyed JSON log records (file log or kafka)
2. ``topic_stage``   log (from earliest) -> decode -> keyed topic, 4 partitions;
                     undecodable records -> the topic's reserved partition -1
                     (one parse, one exactly-once file sink; readers prune it)
3. ``process_stage`` topic (a consumer group) -> route -> enrich -> documents
                     (insert once) + dead-letter topic, in ``foreachBatch``

No stage shuffles except the insert-once aggregation and anti join; routing and
enrichment are narrow.  ``availableNow`` runs them to completion in sequence
(tests, backfills); a ``processingTime`` trigger runs them continuously.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txstream import schemas
from txstream.functions.codec import BAD, parse_json, to_log_record
from txstream.functions.partitioning import partition_of
from txstream.session import scratch_path
from txstream.sources import log as logsrc
from txstream.sources import topic as topics
from txstream.streaming.runner import run_available_now
from txstream.streaming.sinks import process_writer


# Fixed value: the consumer group's name in the source system.
GROUP = "transaction-group"


@dataclass
class ChainPaths:
    log: str
    topic: str
    documents: str
    dead_letters: str
    checkpoints: str
    log_name: str = "transactions"      # name of the log on a broker

    @classmethod
    def under(cls, root: str) -> "ChainPaths":
        return cls(f"{root}/log", f"{root}/topic", f"{root}/documents",
                   f"{root}/dead_letters", f"{root}/_checkpoints")

    def log_address(self, fmt: str) -> str:
        """Folder of the file log, or the broker's name for it."""
        return self.log_name if fmt == "kafka" else self.log

    def with_outputs(self, suffix: str) -> "ChainPaths":
        """Same log and topic, separate documents, dead letters and checkpoints."""
        return replace(self, documents=self.documents + suffix,
                       dead_letters=self.dead_letters + suffix,
                       checkpoints=self.checkpoints + suffix)


def log_stage(transactions: DataFrame, paths: ChainPaths, fmt: str = "parquet",
              kafka_options: dict | None = None):
    """Stage 1 writer: key = text of accountId, value = JSON record.

    ``event_id`` rides along when the input has one (it breaks timestamp ties
    downstream); generated transactions use their id.
    """
    if "event_id" not in transactions.columns:
        transactions = transactions.withColumn("event_id", F.col("accountId"))
    # a broker takes key and value only; there the record's offset breaks ties
    records = to_log_record(transactions, keep=[] if fmt == "kafka" else ["event_id"])
    return logsrc.log_writer(records, paths.log_address(fmt), f"{paths.checkpoints}/log", fmt,
                             kafka_options)


def topic_stage(spark: SparkSession, paths: ChainPaths,
                num_partitions: int = topics.DEFAULT_PARTITIONS, fmt: str = "parquet",
                kafka_options: dict | None = None, **bounds):
    """Stage 2 writer (``fmt``, ``kafka_options``: as for the log's writer; ``bounds``:
    the ``max_*_per_trigger`` arguments of ``read_log``): every log record is parsed once; decoded records go to
    their key's partition, undecodable ones (raw text kept in ``value``) to the
    reserved quarantine partition of the same topic.  One exactly-once sink."""
    log = logsrc.read_log(spark, paths.log_address(fmt), fmt, kafka_options=kafka_options,
                          extra_fields=[T.StructField("event_id", T.LongType())], **bounds)
    if fmt == "kafka":
        log = log.select(F.col("offset").alias("event_id"), "key", "value")
    parsed = parse_json(log.withColumn("value", F.col("value").cast("string")),
                        schemas.TRANSACTION, "value", keep=["event_id"])
    bad = F.col(BAD)
    # a decoded record without an account is account 0: every row keeps a key and a partition
    parsed = parsed.withColumn("accountId", F.coalesce("accountId", F.lit(0).cast("bigint")))
    fields = [F.when(~bad, F.col(f.name)).alias(f.name) for f in schemas.TRANSACTION.fields]
    out = parsed.select(*fields, "event_id", F.when(bad, F.col("value")).alias("value"),
                        F.when(bad, F.lit(topics.QUARANTINE_PARTITION).cast("bigint"))
                         .otherwise(partition_of("accountId", num_partitions))
                         .alias(topics.PARTITION))
    return (out.writeStream.format("parquet").partitionBy(topics.PARTITION)
            .option("path", paths.topic)
            .option("checkpointLocation", f"{paths.checkpoints}/topic"))


def read_quarantine(spark: SparkSession, paths: ChainPaths) -> DataFrame:
    """Records the topic stage could not decode: ``event_id`` and raw ``value``."""
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("value", T.StringType()),
                           T.StructField(topics.PARTITION, T.LongType())])
    return (spark.read.schema(schema).parquet(paths.topic)
            .filter(F.col(topics.PARTITION) == topics.QUARANTINE_PARTITION)
            .select("event_id", "value"))


def process_stage(spark: SparkSession, paths: ChainPaths, start: str = "earliest",
                  fee: int = 5, num_partitions: int = topics.DEFAULT_PARTITIONS,
                  group: str = GROUP, max_files_per_trigger: int | None = None,
                  compact_every: int | None = None, max_bytes_per_trigger: str | None = None,
                  background: bool = False):
    record = schemas.with_fields(schemas.TRANSACTION, T.StructField("event_id", schemas.L))
    group_dir = f"{paths.checkpoints}/{group}"
    stream = topics.scan(spark, paths.topic, record, group=group_dir, start=start,
                         max_files_per_trigger=max_files_per_trigger,
                         max_bytes_per_trigger=max_bytes_per_trigger)
    return process_writer(stream, paths.documents, paths.dead_letters, group_dir, fee,
                          num_partitions, compact_every, background)


def run_chain(spark: SparkSession, transactions: DataFrame, root: str | None = None,
              start: str = "earliest") -> ChainPaths:
    """Run the three stages to completion, one after the other."""
    paths = ChainPaths.under(root or scratch_path(spark, "chain"))
    tag = paths.log.rstrip("/").split("/")[-2][-12:]   # names show up in progress and logs
    run_available_now(log_stage(transactions, paths).queryName(f"log-{tag}"))
    run_available_now(topic_stage(spark, paths).queryName(f"topic-{tag}"))
    run_available_now(process_stage(spark, paths, start=start).queryName(f"process-{tag}"))
    return paths


# Bounds of a long-running chain's micro-batches and how often its stores are merged.
MAX_FILES, MAX_OFFSETS, COMPACT_EVERY = 1000, 10_000_000, 8


def start_chain(spark: SparkSession, transactions: DataFrame, root: str,
                trigger_interval: str = "1 second", start: str = "earliest",
                fmt: str = "parquet", kafka_options: dict | None = None,
                max_files_per_trigger: int | None = MAX_FILES, max_offsets_per_trigger: int | None = MAX_OFFSETS,
                compact_every: int | None = COMPACT_EVERY) -> dict:
    """Start the stages as long-running queries with a processing-time trigger.

    By default a backlog is worked off in bounded micro-batches (files, or offsets of a broker's
    log), and the stores are merged in the background every ``compact_every`` batches.

    The trigger interval is the knob for commit frequency and latency (one
    commit per micro-batch).  Each stage keeps its own checkpoint, so any of
    them can be stopped and restarted independently and resumes where it left
    off.  Returns the running queries by stage name.
    """
    paths = ChainPaths.under(root)

    def go(writer, name):
        return writer.queryName(f"{name}-{abs(hash(root)) % 10**8}") \
            .trigger(processingTime=trigger_interval).start()

    queries = {"log": go(log_stage(transactions, paths, fmt, kafka_options), "log")}
    bounds = ({"max_offsets_per_trigger": max_offsets_per_trigger} if fmt == "kafka"
              else {"max_files_per_trigger": max_files_per_trigger})
    queries["topic"] = go(topic_stage(spark, paths, fmt=fmt, kafka_options=kafka_options, **bounds), "topic")
    queries["process"] = go(process_stage(spark, paths, start=start, compact_every=compact_every,
                                          max_files_per_trigger=max_files_per_trigger, background=True),
                            "process")
    return queries
