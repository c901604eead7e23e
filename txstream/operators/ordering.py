"""Per-key order without funnelling a key into one task.

``keyed_positions`` numbers the rows of every key 1, 2, 3, ... in a given order
-- the result a ``row_number() over (partition by key order by ...)`` would
give -- but range-partitions on ``(key, order)`` instead of hashing on the key.
A key that holds a third of all rows is therefore spread over many contiguous
tasks; each task numbers its slice locally (sorted within the partition), and
one tiny summary (a row per partition, from the slices' marked first and last
rows) supplies the offset of every slice that continues a key, by a running sum.  The numbered slices are written once
to the shared scratch folder (``materialize``): range bounds are sampled per
shuffle, so recomputing them for the summary could cut the slices differently.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from txstream.session import materialize, ship_package


def _default_parts(df: DataFrame) -> int:
    """Range slices by default: the session's shuffle setting (``num_partitions`` overrides)."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keyed_order(df: DataFrame, keys, order, num_partitions: int | None = None) -> DataFrame:
    """Rows of one key contiguous and in order, spread over ``num_partitions`` tasks."""
    keys, order = list(keys), list(order)
    n = num_partitions or _default_parts(df)
    return df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)


def _starts(column: pa.Array, last: pa.Scalar | None) -> np.ndarray:
    """True where a value differs from the one before, in its own type (null equals null and
    NaN equals NaN, as in a window partition).

    ``last`` is the value before the first one; without it the first one starts.
    """
    head = pa.array([None if last is None else last.as_py()], column.type)
    before = pa.concat_arrays([head, column.slice(0, len(column) - 1)])
    both_null = pc.and_(pc.is_null(column), pc.is_null(before))
    same = pc.or_(pc.fill_null(pc.equal(column, before), False), both_null)
    if pa.types.is_floating(column.type):
        both_nan = pc.and_(pc.is_nan(column), pc.is_nan(before))
        same = pc.or_(same, pc.fill_null(both_nan, False))
    out = ~np.asarray(same.to_numpy(zero_copy_only=False), bool)
    if last is None:
        out[0] = True
    return out


def _local_numbering(keys: list[str], weight: str | None = None):
    """Number rows per key run inside one sorted partition, across Arrow batches; with
    ``weight`` (a column of integers >= 0) the running sum of it in place of the number.

    No column leaves Arrow: keys are compared in their own type, all others pass through.
    ``_edge`` marks the slice's first and last row.
    """
    def run(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        last, last_seq, held = None, 0, None

        def out(batch, seq, edge):
            n = batch.num_rows
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, pid, np.int32)), pa.array(seq),
                 pa.array(edge)], names=[*batch.schema.names, "_pid", "_local_seq", "_edge"])

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            new = np.zeros(n, bool)
            for i, c in enumerate(cols):
                new |= _starts(c, None if last is None else last[i])
            start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            steps = np.ones(n, np.int64) if weight is None else np.asarray(
                batch.column(batch.schema.get_field_index(weight)).cast(pa.int64()))
            total = np.cumsum(steps)
            seq = total - np.where(start >= 0, (total - steps)[start], -last_seq)
            edge = np.zeros(n, bool)
            edge[0] = last is None
            last, last_seq = [c[n - 1] for c in cols], int(seq[-1])
            if held is not None:
                yield out(*held)
            held = (batch, seq.astype(np.int64), edge)
        if held is not None:
            held[2][-1] = True
            yield out(*held)
    return run


def keyed_positions(df: DataFrame, keys, order, out: str = "seq",
                    num_partitions: int | None = None, weight: str | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its key, by ``order``.

    ``order`` must make rows unique within a key (add a tie-breaker column).  Keys may
    be null (one key) and of any atomic type; values of all columns stay as they are.
    With ``weight``, a column of integers >= 0 without nulls, ``out`` is its running sum, the row's
    own included.
    """
    keys, order = list(keys), list(order)
    ship_package(df.sparkSession)
    ranged = keyed_order(df, keys, order, num_partitions)
    schema = T.StructType(ranged.schema.fields + [T.StructField("_pid", T.IntegerType(), False),
                                                  T.StructField("_local_seq", T.LongType(), False),
                                                  T.StructField("_edge", T.BooleanType(), False)])
    # Range bounds are sampled per exchange, so the numbered rows are written
    # once and every consumer below reads the same slices.
    local = materialize(ranged.mapInArrow(_local_numbering(keys, weight), schema), "positions")

    # Only the slices' first and last rows: at most two rows a partition.
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    # the smaller key is the head, and the last key's row of the larger number the tail
    ends = (local.where("_edge").select("_pid", key.alias("k"), "_local_seq")
            .groupBy("_pid").agg(F.min("k").alias("head"),
                                 F.max(F.struct("k", "_local_seq")).alias("t"))
            .select("_pid", "head", F.col("t.k").alias("tail"),
                    F.col("t._local_seq").alias("count")))
    # rows of the tail key up to the end of the slice: a running sum, one row a slice
    upto = F.sum("count").over(Window.partitionBy("tail").orderBy("_pid"))
    by_slice = Window.orderBy("_pid")
    offsets = (ends.withColumn("upto", upto)
               .withColumn("before", F.lag("tail").over(by_slice))
               .withColumn("offset", F.lag("upto").over(by_slice))
               .where(F.col("before").eqNullSafe(F.col("head")) & F.col("before").isNotNull())
               .select(F.col("_pid").alias("_opid"), F.col("head").alias("_head"),
                       F.col("offset").alias("_offset")))
    on = (F.col("_pid") == F.col("_opid")) & key.eqNullSafe(F.col("_head"))
    return (local.join(offsets, on, "left")
                 .withColumn(out, F.col("_local_seq") + F.coalesce(F.col("_offset"), F.lit(0)))
                 .drop("_pid", "_opid", "_local_seq", "_edge", "_offset", "_head"))
