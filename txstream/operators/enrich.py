"""Row-wise enrichment, document projection and whole-row duplicate detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DEFAULT_FEE = 5  # fixed value: the constant transaction fee


def enrich_fee(df: DataFrame, fee: int = DEFAULT_FEE) -> DataFrame:
    """Add ``transactionFee`` as a constant BIGINT; other columns unchanged."""
    return df.withColumn("transactionFee", F.lit(fee).cast("bigint"))


def to_document(df: DataFrame, keep=()) -> DataFrame:
    """Document layout: ``_id`` (= accountId), amount, timestamp, transactionFee."""
    return df.select(*keep, F.col("accountId").alias("_id"), "amount", "timestamp",
                     "transactionFee")


def exact_duplicates(df: DataFrame, cols=None) -> DataFrame:
    """Rows equal on every given column (default: all) that occur more than once.

    A hash aggregation with map-side partial counts, so a hot row value is
    pre-counted on each executor before the shuffle.
    """
    cols = list(cols or df.columns)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1))
