"""Split a transaction stream into its main output and its dead letters.

A row is *main* when ``amount > 0``; every other row -- zero, negative, or an
amount that is missing (null) -- is a dead letter.  The two predicates are exact
complements, so main and dead letters partition the input.  Both are narrow
filters: no shuffle, and on a Parquet scan the main predicate is pushed down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def is_main(amount: str | Column = "amount") -> Column:
    """``amount > 0``; null counts as false (a filter drops it)."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return amount > 0


def is_dead_letter(amount: str | Column = "amount") -> Column:
    """The exact complement of :func:`is_main`, written so Parquet can push it down."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return (amount <= 0) | amount.isNull()


def route(df: DataFrame, amount: str = "amount") -> tuple[DataFrame, DataFrame]:
    """Return ``(main, dead_letters)``; rows are passed through unchanged."""
    return df.filter(is_main(amount)), df.filter(is_dead_letter(amount))


def split_counts(df: DataFrame, by: str = "partition", amount: str = "amount") -> DataFrame:
    """Conservation check of :func:`route` per group, in one aggregation pass."""
    return (df.groupBy(by)
              .agg(F.count(F.lit(1)).alias("n_in"),
                   F.count_if(is_main(amount)).alias("n_main"),
                   F.count_if(is_dead_letter(amount)).alias("n_dead")))
