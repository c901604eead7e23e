"""Sets of integers as disjoint ranges, kept up to date batch by batch.

A set is a table ``b, lo, hi``: ranges that neither touch nor cross a bucket of
``2^bits`` integers (``b`` = ``lo >> bits``).  A complete bucket is one row, so the table's size
is that of the gaps and of the buckets in use, not of the integers.  All windows are by
bucket, so none holds more than ``2^bits`` rows.

``add_batch`` merges a batch's ids into the set on a stream: the state after each batch is
written under the batch id, a replayed batch rewrites the same rows, and nothing read before is
read again.  Null ids are left out; ids may repeat inside and across batches; they lie below
2^63 - 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from txstream.operators.audit import gaps_between
from txstream.session import materialize
from txstream.sources.fs import delete, list_dirs, path_exists

BITS = 20
SCHEMA = "b long, lo long, hi long"


def islands(ranges: DataFrame) -> DataFrame:
    """Ranges of a bucket that overlap or touch become one."""
    w = Window.partitionBy("b").orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reach.isNull() | (F.col("lo") - 1 > reach), 1).otherwise(0)
    numbered = ranges.withColumn("_s", starts).withColumn("_g", F.sum("_s").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("b", "_g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_g")


def of_ids(ids: DataFrame, key: str = "id", bits: int = BITS) -> DataFrame:
    """The ranges of a column of integers."""
    x = F.col(key).cast("long")
    rows = ids.select(x.alias("lo")).where(F.col("lo").isNotNull()).distinct()
    return islands(rows.select(F.shiftright("lo", bits).alias("b"), "lo", F.col("lo").alias("hi")))


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ranges of the integers in either set (of equal buckets)."""
    return islands(a.select("b", "lo", "hi").unionByName(b.select("b", "lo", "hi")))


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ranges of the integers in ``a`` and not in ``b`` (of equal buckets), by one sweep over the
    ends of both: no pair of ranges is compared."""
    def ends(df: DataFrame, sign: Column, other: Column):
        return df.select("b", F.explode(F.array(
            F.struct(F.col("lo").alias("at"), sign.alias("a"), other.alias("o")),
            F.struct((F.col("hi") + 1).alias("at"), (-sign).alias("a"), (-other).alias("o")))).alias("e")) \
            .select("b", "e.*")

    both = ends(a, F.lit(1), F.lit(0)).unionByName(ends(b, F.lit(0), F.lit(1))) \
        .groupBy("b", "at").agg(F.sum("a").alias("a"), F.sum("o").alias("o"))
    w = Window.partitionBy("b").orderBy("at")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.select("b", F.col("at").alias("lo"), (F.lead("at").over(w) - 1).alias("hi"),
                        F.sum("a").over(upto).alias("in_a"), F.sum("o").over(upto).alias("in_b"))
    return islands(swept.where("in_a > 0 and in_b = 0 and hi is not null").select("b", "lo", "hi"))


def gaps(ranges: DataFrame) -> DataFrame:
    """gap_start, gap_end, missing between consecutive ranges, also across buckets."""
    return gaps_between(ranges.select("lo", "hi"))


def stitched(ranges: DataFrame, bits: int = BITS) -> DataFrame:
    """``lo, hi`` of maximal ranges: those that touch across the buckets' edges become one.

    Only ranges at an edge go on to the next level (buckets of buckets), so no window holds more
    than two rows for each bucket inside its own.
    """
    rows, out = materialize(ranges.select("b", "lo", "hi"), "ranges"), None
    shifts = [*range(bits, 64, bits), 64]
    for here, above in zip(shifts, shifts[1:]):
        last = F.shiftleft(F.shiftright("hi", here), here) + ((1 << here) - 1)
        edge = (F.col("lo") == F.shiftleft(F.shiftright("lo", here), here)) | (F.col("hi") == last)
        done = rows.where(~edge).select("lo", "hi")
        out = done if out is None else out.unionByName(done)
        b = F.shiftright("lo", above) if above < 64 else F.lit(0).cast("long")
        rows = islands(rows.where(edge).select(b.alias("b"), "lo", "hi"))
    return out.unionByName(rows.select("lo", "hi"))


def _state(state: str, batch_id: int) -> str:
    return f"{state}/batch={batch_id}"


def _batches(spark: SparkSession, state: str) -> list[int]:
    return sorted(int(d[6:]) for d in list_dirs(spark, state)
                  if d.startswith("batch=") and path_exists(spark, f"{state}/{d}/_SUCCESS"))


def ranges_after(spark: SparkSession, state: str, batch_id: int | None = None) -> DataFrame:
    """The set after ``batch_id`` (default: the newest batch; empty before the first)."""
    found = [b for b in _batches(spark, state) if batch_id is None or b <= batch_id]
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(_state(state, found[-1]))


def add_batch(batch: DataFrame, batch_id: int, state: str, key: str = "id", bits: int = BITS,
              keep: int = 2) -> None:
    """Merge the batch's ids into the set of the batch before; the last ``keep`` states stay."""
    spark = batch.sparkSession
    earlier = [b for b in _batches(spark, state) if b < batch_id]
    found = of_ids(batch, key, bits)
    if earlier:
        found = union(spark.read.schema(SCHEMA).parquet(_state(state, earlier[-1])), found)
    found.write.mode("overwrite").parquet(_state(state, batch_id))
    for b in earlier[:-(keep - 1)] if keep > 1 else earlier:
        delete(spark, _state(state, b))
