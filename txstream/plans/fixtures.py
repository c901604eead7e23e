"""Record fixtures derived by Spark from the driver's tables (see FIXTURES.md).

Every fixture is a lazy transform of a given table, so its work grows with the
table.  ``*_SQL`` strings are the DuckDB twins used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txstream.functions.clock import ntz_to_ms
from txstream.functions.codec import encode_json
from txstream.functions.partitioning import partition_of, partition_of_sql
from txstream.sources.fs import is_dir

# Fixed values of the fixtures.
GENERATED_EPOCH_MS = 1704067200000   # generated clock: base + id * 100
GENERATED_STEP_MS = 100
CORRUPT_EVERY = 97                   # raw_records: every 97th record is "{bad"
CORRUPT_TEXT = "{bad"
LAG_FACTOR, LAG_MOD = 37, 1000       # lag = (event_id * 37) % 1000
DROP_EVERY, REPLAY_EVERY = 97, 50    # delivered: lose every 97th id, replay every 50th
ALTER_EVERY, ALTER_REM = 625, 1      # delivered: payload altered where id % 625 = 1
TOPIC_PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None):
    """The whole ``events`` table as a file stream, be it a folder of files or one file."""
    path = f"{sf_dir}/events.parquet"
    r = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_dir(spark, path):
        return r.parquet(path)
    # a file source takes folders only: the parent, restricted to the file's name
    return r.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def transactions_from_events(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.col("user_id").alias("accountId"),
                         ntz_to_ms("ts").alias("timestamp"),
                         F.floor("value").cast("bigint").alias("amount"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(table(spark, sf_dir, "events"))


TX_SQL = ("select event_id, user_id as accountId, epoch_us(ts) // 1000 as timestamp, "
          "cast(floor(value) as bigint) as amount from events")


def customer_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with negative amounts: one per customer, amount = floor(balance)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("event_id"), F.col("c_custkey").alias("accountId"),
                    (F.lit(GENERATED_EPOCH_MS) + F.col("c_custkey") * GENERATED_STEP_MS)
                    .cast("bigint").alias("timestamp"),
                    F.floor("c_acctbal").cast("bigint").alias("amount"))


CUSTOMER_TX_SQL = (f"select c_custkey as event_id, c_custkey as accountId, "
                   f"{GENERATED_EPOCH_MS} + c_custkey * {GENERATED_STEP_MS} as timestamp, "
                   f"cast(floor(c_acctbal) as bigint) as amount from customer")


def raw_records_from(tx: DataFrame) -> DataFrame:
    good = encode_json("accountId", "timestamp", "amount")
    return tx.select("event_id", F.when(F.col("event_id") % CORRUPT_EVERY == 0,
                                        F.lit(CORRUPT_TEXT)).otherwise(good).alias("value"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records_from(transactions(spark, sf_dir))


def with_partition(df: DataFrame, key: str = "accountId") -> DataFrame:
    return df.withColumn("partition", partition_of(key, TOPIC_PARTITIONS))


PART_SQL = partition_of_sql("accountId", TOPIC_PARTITIONS)


def lag_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = with_partition(transactions(spark, sf_dir))
    return tx.select("event_id", "partition", "timestamp",
                     ((F.col("event_id") * LAG_FACTOR) % LAG_MOD).alias("lag"))


LAG_SQL = (f"select event_id, {PART_SQL} as partition, timestamp, "
           f"(event_id * {LAG_FACTOR}) % {LAG_MOD} as lag from ({TX_SQL}) t")


def sequence_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The produced sequence: id = event_id, timestamp = event time, payload = text of id."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), ntz_to_ms("ts").alias("timestamp"),
                    F.col("event_id").cast("string").alias("payload"))


def sequence_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("id"), ntz_to_ms("ts").alias("timestamp"),
                         F.col("event_id").cast("string").alias("payload"))


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an at-least-once consumer received: some ids lost, some twice, some altered."""
    return delivered_from(sequence_events(spark, sf_dir))


def delivered_from(seq: DataFrame) -> DataFrame:
    """The same of any sequence, a stream too."""
    altered = F.when(F.col("id") % ALTER_EVERY == ALTER_REM,
                     F.concat(F.col("payload"), F.lit("!"))).otherwise(F.col("payload"))
    seq = seq.withColumn("payload", altered)
    return (seq.filter(F.col("id") % DROP_EVERY != 0)
               .unionByName(seq.filter(F.col("id") % REPLAY_EVERY == 0)))


SEQ_SQL = ("select event_id as id, epoch_us(ts) // 1000 as timestamp, "
           "cast(event_id as varchar) as payload from events")
DELIVERED_SQL = (
    f"with s as (select id, timestamp, case when id % {ALTER_EVERY} = {ALTER_REM} "
    f"then payload || '!' else payload end as payload from ({SEQ_SQL}) q) "
    f"select * from s where id % {DROP_EVERY} <> 0 "
    f"union all select * from s where id % {REPLAY_EVERY} = 0")
