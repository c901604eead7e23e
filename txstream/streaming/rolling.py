"""Text files that roll by size, age and idle time.

Lines of a time bucket are gathered until they fill a file of about ``target`` bytes: a line
belongs to the file in which it begins, so a file is at most one line longer.  Rows that do not
fill a file yet wait in a state table; they are written as a shorter file once their bucket got no
line for ``idle_ms`` or the oldest of them has waited for ``age_ms``.

Running byte sums come from ``keyed_positions`` (range slices and their offsets), so a hot
bucket is spread over tasks; every finished file is written by one task.  Files of a batch stand
under ``bucket=<b>/part=<batch>-<n>``; a replayed batch reads the state before it and rewrites the
same files.  ``close_idle`` applies the two time limits between batches: call it from a timer, as a
stream calls nothing while no rows arrive.  All times are arguments, so a test sets the clock.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from txstream.functions.clock import ms_to_ntz
from txstream.operators.ordering import keyed_positions
from txstream.sources.fs import delete, list_dirs, path_exists
from txstream.streaming.sinks import HOURLY_BUCKET

# The rolling policy's defaults (1 MiB, 1 minute idle, 5 minutes of age).
TARGET_BYTES, IDLE_MS, AGE_MS = 1 << 20, 60_000, 300_000
SCHEMA = "bucket string, value string, arrived long, b long, t long, h long"


def _states(spark: SparkSession, state: str) -> list[tuple[int, int]]:
    """(batch, tick) of all complete states, oldest first."""
    found = []
    for name in list_dirs(spark, state):
        if name.startswith("step=") and path_exists(spark, f"{state}/{name}/_SUCCESS"):
            batch, tick = name[5:].split("-")
            found.append((int(batch), int(tick)))
    return sorted(found)


def _path(state: str, step: tuple[int, int]) -> str:
    return f"{state}/step={step[0]}-{step[1]}"


def waiting(spark: SparkSession, state: str, before: int | None = None) -> DataFrame:
    """Rows that wait for their file to fill (before a batch, or now)."""
    found = [s for s in _states(spark, state) if before is None or s[0] < before]
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(_path(state, found[-1]))


def _roll(rows: DataFrame, step: tuple[int, int], now_ms: int, out: str, state: str, target: int,
          idle_ms: int, age_ms: int) -> None:
    """Write the files that are full or over their time; the rest is the state of this step."""
    spark = rows.sparkSession
    sized = rows.withColumn("size", F.octet_length("value").cast("long") + 1)
    placed = keyed_positions(sized, ["bucket"], ["b", "t", "h", "value"], "upto", weight="size")
    file = F.expr(f"(upto - size) div {int(target)}")
    placed = placed.withColumn("n", file)
    # one row a bucket, and one a bucket's last file
    ends = placed.groupBy("bucket").agg(F.max("upto").alias("total"), F.max("n").alias("last"),
                                        F.max("arrived").alias("touched"))
    opened = placed.groupBy(F.col("bucket").alias("_b"), "n").agg(F.min("arrived").alias("opened"))
    limits = ends.join(opened, ends["bucket"].eqNullSafe(F.col("_b")) & (ends["last"] == opened["n"])).select(
        ends["bucket"].alias("_k"), "last",
        ((F.col("last") + 1) * target <= F.col("total")).alias("full"),
        ((F.lit(now_ms) - F.col("touched") >= idle_ms) | (F.lit(now_ms) - F.col("opened") >= age_ms)).alias("late"))
    judged = placed.join(limits, placed["bucket"].eqNullSafe(F.col("_k"))) \
        .withColumn("done", (F.col("n") < F.col("last")) | F.col("full") | F.col("late"))
    name = F.concat(F.lit(f"{step[0]}-{step[1]}-"), F.col("n").cast("string"))
    (judged.where("done").withColumn("part", name)
           .repartition("bucket", "part").sortWithinPartitions("bucket", "part", "b", "t", "h", "value")
           .select("value", "bucket", "part").write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "part").text(out))
    (judged.where(~F.col("done")).select("bucket", "value", "arrived", "b", "t", "h")
           .write.mode("overwrite").parquet(_path(state, step)))


def _forget(spark: SparkSession, state: str, before: tuple[int, int]) -> None:
    """Delete all states older than the newest one before ``before`` (a replay needs that one)."""
    for s in [s for s in _states(spark, state) if s < before][:-1]:
        delete(spark, _path(state, s))


def roll_batch(batch: DataFrame, batch_id: int, out: str, state: str, now_ms: int, line: Column,
               time_ms: str = "timestamp", bucket_format: str = HOURLY_BUCKET, target: int = TARGET_BYTES,
               idle_ms: int = IDLE_MS, age_ms: int = AGE_MS) -> None:
    """Add a micro-batch that arrived at ``now_ms``; files it fills or that are over their time are written."""
    spark = batch.sparkSession
    new = batch.select(F.date_format(ms_to_ntz(time_ms), bucket_format).alias("bucket"), line.alias("value"),
                       F.lit(now_ms).cast("long").alias("arrived"), F.lit(batch_id).cast("long").alias("b"),
                       F.col(time_ms).cast("long").alias("t")).withColumn("h", F.xxhash64("value"))
    _roll(waiting(spark, state, batch_id).unionByName(new), (batch_id, 0), now_ms, out, state, target, idle_ms, age_ms)
    _forget(spark, state, (batch_id, 0))


def close_idle(spark: SparkSession, out: str, state: str, now_ms: int, target: int = TARGET_BYTES,
               idle_ms: int = IDLE_MS, age_ms: int = AGE_MS) -> bool:
    """Between batches: write what has waited too long by ``now_ms``; whether anything waits on."""
    found = _states(spark, state)
    if not found:
        return False
    batch, tick = found[-1]
    rows = waiting(spark, state)
    _roll(rows, (batch, tick + 1), now_ms, out, state, target, idle_ms, age_ms)
    _forget(spark, state, (batch, tick + 1))
    return waiting(spark, state).limit(1).count() > 0


def rolling_text_writer(stream: DataFrame, line: Column, out: str, state: str, checkpoint: str,
                        clock=lambda: int(time.time() * 1000), **options) -> DataStreamWriter:
    """The stream's lines into rolling text files (``options``: those of :func:`roll_batch`)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        roll_batch(batch, batch_id, out, state, clock(), line, **options)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)


def read_lines(spark: SparkSession, out: str) -> DataFrame:
    """bucket, part and line (``value``) of the finished files."""
    return spark.read.schema("value string, bucket string, part string").text(out)
