"""Positions of a key's rows that go on from micro-batch to micro-batch.

Inside a batch rows are numbered by ``keyed_positions`` (range slices, no hot task); a key's
number of rows in earlier batches is added.  Each batch writes its counts per key, a small table
under its batch id; every ``fold_every`` batches the older ones are summed into a base, so that a
batch reads at most one base and ``fold_every`` count tables.  Counts are summed on the map
side before they are shuffled, and the join adds one number a key, so Spark may split a hot key's rows
(AQE's skew join) or broadcast the counts.  A replayed batch reads the counts before it and
rewrites the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from txstream.operators.ordering import keyed_positions
from txstream.sources.fs import delete, list_dirs, path_exists

BASE = "_base"


def _versions(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    return sorted(int(d[len(prefix):]) for d in list_dirs(spark, folder)
                  if d.startswith(prefix) and path_exists(spark, f"{folder}/{d}/_SUCCESS"))


def counts_before(spark: SparkSession, state: str, batch_id: int, keys: list[str]) -> DataFrame | None:
    """Rows of every key in the batches before ``batch_id``: the keys and ``_before``."""
    base = [v for v in _versions(spark, f"{state}/{BASE}", "v=") if v < batch_id]
    after = base[-1] if base else -1
    paths = [f"{state}/{BASE}/v={after}"] if base else []
    paths += [f"{state}/batch={b}" for b in _versions(spark, state, "batch=") if after < b < batch_id]
    if not paths:
        return None
    rows = None
    for p in paths:                     # a folder of its own each, read with its own schema
        df = spark.read.parquet(p)
        rows = df if rows is None else rows.unionByName(df)
    return rows.groupBy(*keys).agg(F.sum("_before").alias("_before"))


def number_batch(batch: DataFrame, batch_id: int, keys, order, out: str, state: str, name: str = "seq",
                 fold_every: int = 20, num_partitions: int | None = None) -> None:
    """Write the batch with its continued positions to ``out/batch=<batch_id>``."""
    spark, keys = batch.sparkSession, list(keys)
    rows = keyed_positions(batch, keys, list(order), name, num_partitions)
    before = counts_before(spark, state, batch_id, keys)
    if before is not None:
        other = before.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before")
        on = None
        for i, k in enumerate(keys):
            c = rows[k].eqNullSafe(F.col(f"_k{i}"))
            on = c if on is None else on & c
        rows = rows.join(other, on, "left").withColumn(
            name, F.col(name) + F.coalesce("_before", F.lit(0))).select(*batch.columns, name)
    rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    (batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_before"))
          .write.mode("overwrite").parquet(f"{state}/batch={batch_id}"))
    if batch_id > 0 and batch_id % fold_every == 0:
        fold(spark, state, batch_id - 1, keys)


def fold(spark: SparkSession, state: str, upto: int, keys) -> None:
    """Sum the counts of all batches up to ``upto`` (committed ones) into a base.

    What the base before this one covers is deleted; what the new one covers stays until the next
    fold, for readers and replays.
    """
    bases = _versions(spark, f"{state}/{BASE}", "v=")
    if bases and bases[-1] >= upto:
        return
    total = counts_before(spark, state, upto + 1, list(keys))
    if total is None:
        return
    total.write.mode("overwrite").parquet(f"{state}/{BASE}/v={upto}")
    for v in bases[:-1]:
        delete(spark, f"{state}/{BASE}/v={v}")
    if bases:
        for b in _versions(spark, state, "batch="):
            if b <= bases[-1]:
                delete(spark, f"{state}/batch={b}")


def positions_writer(stream: DataFrame, keys, order, out: str, state: str, checkpoint: str,
                     name: str = "seq", fold_every: int = 20,
                     num_partitions: int | None = None) -> DataStreamWriter:
    """A stream's rows with each key's positions 1, 2, 3, ... over all batches."""
    def each(batch: DataFrame, batch_id: int) -> None:
        number_batch(batch, batch_id, keys, order, out, state, name, fold_every, num_partitions)
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
