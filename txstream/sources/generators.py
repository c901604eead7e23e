"""Record generators over an id column: transactions, payload events, sequence events.

A generator is a function ``(id_col, clock_col) -> [Column]``; it can be applied
to ``spark.range`` (bounded batch), to the ``rate`` / ``rate-micro-batch``
streaming sources (rate-limited, unbounded), or to ids Spark reads from a table.
All of it is column expressions: no Python on the data path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txstream.functions.clock import now_ms

# Default filler size and default rates (rows per second) per record type.
DEFAULT_PAYLOAD_SIZE = 100
FILLER_CHAR = "*"
DEFAULT_RATES = {"transactions": 10, "sequence_events": 1, "payload_events": 1000}


def transaction_columns(id_col: Column, clock: Column) -> list[Column]:
    """accountId = id, timestamp = clock, amount = id % 10 (every 10th amount is 0)."""
    return [id_col.cast("bigint").alias("accountId"), clock.cast("bigint").alias("timestamp"),
            (id_col % 10).cast("bigint").alias("amount")]


def payload_event_columns(id_col: Column, clock: Column,
                          payload_size: int = DEFAULT_PAYLOAD_SIZE) -> list[Column]:
    """id as text, timestamp = clock, a fixed filler of ``payload_size`` chars ("" if <= 0)."""
    return [id_col.cast("string").alias("id"), clock.cast("bigint").alias("timestamp"),
            F.repeat(F.lit(FILLER_CHAR), max(payload_size, 0)).alias("payload")]


def sequence_event_columns(id_col: Column, clock: Column) -> list[Column]:
    """id, timestamp = clock, payload = text of id (so a reader can verify content)."""
    return [id_col.cast("bigint").alias("id"), clock.cast("bigint").alias("timestamp"),
            id_col.cast("string").alias("payload")]


GENERATORS = {
    "transactions": transaction_columns,
    "payload_events": payload_event_columns,
    "sequence_events": sequence_event_columns,
}


def columns_of(kind, id_col: Column, clock: Column, **kw) -> list[Column]:
    """Columns of a built-in record type, or of a caller's ``(id_col, clock) -> [Column]``."""
    return (kind if callable(kind) else GENERATORS[kind])(id_col, clock, **kw)


def generate(spark: SparkSession, n: int, kind: str = "transactions",
             num_partitions: int | None = None, clock: Column | None = None,
             **kw) -> DataFrame:
    """Bounded batch of ``n`` generated rows over ids ``0..n-1``."""
    ids = spark.range(0, n, 1, num_partitions)
    clock = now_ms() if clock is None else clock
    return ids.select(*columns_of(kind, F.col("id"), clock, **kw))


def generate_from(df: DataFrame, id_col: str, kind: str = "transactions",
                  clock: Column | None = None, keep=(), **kw) -> DataFrame:
    """Apply a generator to an id column of any frame (batch or stream)."""
    clock = now_ms() if clock is None else clock
    return df.select(*keep, *columns_of(kind, F.col(id_col), clock, **kw))


def generate_stream(spark: SparkSession, kind: str = "transactions",
                    rows_per_second: int | None = None, num_partitions: int = 1,
                    deterministic: bool = False, start_ms: int = 0, **kw) -> DataFrame:
    """Unbounded, rate-limited stream; ids 0, 1, 2, ... and a per-row clock.

    ``deterministic=True`` uses ``rate-micro-batch``: ``rows_per_second`` rows per
    micro-batch with timestamps fixed by ``start_ms`` -- repeatable in tests.
    The default rate depends on the record type (``DEFAULT_RATES``).
    """
    if rows_per_second is None:
        rows_per_second = 1 if callable(kind) else DEFAULT_RATES[kind]
    if deterministic:
        src = (spark.readStream.format("rate-micro-batch")
               .option("rowsPerBatch", rows_per_second)
               .option("numPartitions", num_partitions)
               .option("startTimestamp", start_ms)
               .option("advanceMillisPerBatch", 1000).load())
    else:
        src = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
               .option("numPartitions", num_partitions).load())
    clock = F.unix_millis(F.col("timestamp"))
    return src.select(*columns_of(kind, F.col("value"), clock, **kw))
