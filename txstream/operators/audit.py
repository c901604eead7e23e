"""Delivery audits: what was produced but not delivered, delivered twice, or altered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from txstream.session import materialize


def audit_missing(produced: DataFrame, delivered: DataFrame, key: str = "id") -> DataFrame:
    """Keys produced but never delivered.

    Delivered keys are de-duplicated first (map-side partial aggregation), so a
    key replayed many times cannot skew the anti join's build side.
    """
    return produced.select(key).join(delivered.select(key).distinct(), key, "left_anti")


def audit_duplicates(delivered: DataFrame, key: str = "id") -> DataFrame:
    """Keys delivered more than once, with their copy count."""
    return (delivered.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
                     .filter(F.col("copies") > 1))


def gaps_between(ranges: DataFrame, bucket_bits: int = 20) -> DataFrame:
    """Gaps between consecutive disjoint ranges of integers (``lo``, ``hi``): gap_start,
    gap_end, missing.

    Ranges are cut into value buckets of ``2^bucket_bits`` by their start and paired with
    ``lead`` inside each.  What the rest needs -- ranges before a gap and the first and last one
    of a bucket -- is written once: a table of about the gaps and the buckets, from which both
    the gaps and a row a bucket are read.  These rows are paired in the same way in buckets of buckets,
    until a last level of at most 2^(64 mod bucket_bits) rows: no window partition holds more
    than ``2^bucket_bits`` rows, however sparse the integers are.
    """
    def paired(rows: DataFrame, shift: int) -> DataFrame:
        bucket = F.shiftright("lo", shift) if shift < 64 else F.lit(0).cast("bigint")
        w = Window.partitionBy("b").orderBy("lo")
        return rows.select("lo", "hi", bucket.alias("b")).withColumns(
            {"nxt": F.lead("lo").over(w), "prev": F.lag("lo").over(w)})

    gap = F.col("nxt") - 1 > F.col("hi")
    shifts = [*range(bucket_bits, 64, bucket_bits), 64]
    first = paired(ranges, shifts[0]).where(gap | F.col("nxt").isNull() | F.col("prev").isNull())
    level, pairs = materialize(first, "gap-edges"), None
    for i in range(len(shifts)):
        found = level.select("hi", "nxt").where(gap)
        pairs = found if pairs is None else pairs.unionByName(found)
        if i + 1 < len(shifts):
            rows = level.groupBy("b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            level = paired(rows, shifts[i + 1])
    return pairs.select((F.col("hi") + 1).alias("gap_start"), (F.col("nxt") - 1).alias("gap_end"),
                        F.try_subtract(F.col("nxt") - 1, F.col("hi")).alias("missing"))


def audit_gaps(delivered: DataFrame, key: str = "id", bucket_bits: int = 20) -> DataFrame:
    """Ranges of integer keys missing between consecutive delivered keys.

    Every key is a range of its own for :func:`gaps_between`.  Gaps before the first and
    after the last delivered key are :func:`audit_missing`'s business.
    """
    rows = delivered.select(F.col(key).alias("lo")).where(F.col("lo").isNotNull()).distinct()
    return gaps_between(rows.withColumn("hi", F.col("lo")), bucket_bits)


def audit_payload(delivered: DataFrame, key: str = "id", payload: str = "payload") -> DataFrame:
    """Rows whose payload is not the text of their id (null-safe)."""
    return delivered.filter(~F.col(payload).eqNullSafe(F.col(key).cast("string")))
