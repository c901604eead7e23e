"""Key -> topic-partition assignment.

The partition of a record is the first 32 bits of ``md5(text of key)`` modulo
the partition count: stable across runs, engines and languages, so a DuckDB
oracle and any other reader can recompute it.  Same key, same partition.  An absent
(null) key is key 0, as in a record whose numeric key field is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_text(key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(key.cast("string"), F.lit("0"))


def partition_of(key: Column | str, num_partitions: int) -> Column:
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    h32 = F.conv(F.substring(F.md5(key_text(key)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h32, F.lit(num_partitions).cast("bigint"))


def partition_of_sql(key_sql: str, num_partitions: int) -> str:
    """DuckDB twin of :func:`partition_of` for oracle queries."""
    return (f"(cast(('0x' || substr(md5(coalesce(cast({key_sql} as varchar), '0')), 1, 8)) as bigint)"
            f" % {num_partitions})")
