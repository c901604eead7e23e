"""Insert-once document store.

Documents are keyed by ``_id``; a key is written once and never replaced.  Inside
one batch the first row per key by ``(timestamp, event_id)`` wins; across
batches the earlier batch wins.  The store is a Parquet table with one
``batch=<id>`` directory per micro-batch:

* ``first_per_key`` is an aggregation (``min`` of a struct led by the order
  columns; sort-based, since a struct is no fixed-width buffer) -- partial on every
  map task, so a key that holds a third of all rows is reduced before the shuffle.
* the anti join against stored keys reads only the ``_id`` column and only
  batches older than this one; AQE picks a broadcast when the batch's keys turn
  out small at run time and keeps a shuffle join otherwise.
* the batch's directory is overwritten as a whole, so a replayed batch (at-least-
  once delivery from ``foreachBatch``) writes the same rows again: effectively once.
* ``compact`` folds all batches up to ``k`` into a base version ``_base/v=<k>``
  (an LSM-style merge) so the number of directories a batch has to list and
  scan stays bounded.  Readers use the newest complete base plus the batches
  after it; deleting what a base covers is garbage collection, so a crash at
  any point leaves a consistent store.

:mod:`txstream.operators.keyed_store` keeps the same documents at steady cost a batch (sorted
runs, merged level by level); the chain writes that one, and ``read_documents`` reads both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txstream.sources.fs import delete, has_data_files, list_dirs, path_exists

BASE = "_base"


def first_per_key(df: DataFrame, key: str, order=("timestamp", "event_id")) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple."""
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_m")
    return (df.groupBy(key).agg(best)
              .select(key, *[F.col(f"_m.{c}").alias(c) for c in order + rest])
              .select(*df.columns))


def latest_base(spark: SparkSession, store: str) -> int | None:
    """Newest complete base version (its write has committed), or None."""
    versions = []
    for name in list_dirs(spark, f"{store}/{BASE}"):
        if name.startswith("v=") and path_exists(spark, f"{store}/{BASE}/{name}/_SUCCESS"):
            versions.append(int(name[2:]))
    return max(versions) if versions else None


def _deltas(spark: SparkSession, store: str, after: int | None,
            before: int | None) -> DataFrame | None:
    batches = sorted(int(n[6:]) for n in list_dirs(spark, store) if n.startswith("batch="))
    # a batch without rows of this kind leaves a folder without data files
    paths = [f"{store}/batch={b}" for b in batches
             if (after is None or b > after) and (before is None or b < before)
             and has_data_files(spark, f"{store}/batch={b}")]
    if not paths:
        return None
    d = spark.read.option("basePath", store).parquet(*paths)
    if "partition" in d.columns:        # directory values are inferred as int
        d = d.withColumn("partition", F.col("partition").cast("bigint"))
    return d.drop("batch")


def _documents(spark: SparkSession, store: str, before: int | None) -> DataFrame | None:
    v = latest_base(spark, store)
    parts = []
    if v is not None:
        parts.append(spark.read.parquet(f"{store}/{BASE}/v={v}"))
    d = _deltas(spark, store, v, before)
    if d is not None:
        parts.append(d)
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stored_keys(spark: SparkSession, store: str, key: str = "_id",
                before_batch: int | None = None) -> DataFrame | None:
    docs = _documents(spark, store, before_batch)
    return None if docs is None else docs.select(key)


def insert_once(batch: DataFrame, store: str, batch_id: int, key: str = "_id",
                order=("timestamp", "event_id"), columns=None) -> DataFrame:
    """Write the new documents of one batch to ``store/batch=<batch_id>``.

    Returns the frame that was written (lazy; the caller may count it).
    """
    spark = batch.sparkSession
    columns = list(columns or [c for c in batch.columns if c != "event_id"])
    candidates = first_per_key(batch, key, order)
    existing = stored_keys(spark, store, key, before_batch=batch_id)
    if existing is not None:
        stored = existing.select(F.col(key).alias("_stored"))
        candidates = candidates.join(stored, candidates[key].eqNullSafe(F.col("_stored")),
                                     "left_anti")
    new = candidates.select(*columns)
    new.write.mode("overwrite").parquet(f"{store}/batch={batch_id}")
    return new


def read_documents(spark: SparkSession, store: str, columns=None, schema=None) -> DataFrame:
    """The store's rows; with ``schema`` a store without rows is empty instead of an error."""
    from txstream.operators import keyed_store

    if keyed_store.exists(spark, store):
        return keyed_store.read(spark, store, columns, schema)
    docs = _documents(spark, store, None)
    if docs is None:
        if schema is None:
            raise FileNotFoundError(f"no documents under {store}")
        docs = spark.createDataFrame([], schema)
    return docs.select(*(columns or docs.columns))


def vacuum_covered(spark: SparkSession, store: str) -> None:
    """Delete the bases and batches that the newest base covers."""
    v = latest_base(spark, store)
    if v is None:
        return
    for name in list_dirs(spark, f"{store}/{BASE}"):
        if name.startswith("v=") and int(name[2:]) < v:
            delete(spark, f"{store}/{BASE}/{name}")
    for name in list_dirs(spark, store):
        if name.startswith("batch=") and int(name[6:]) <= v:
            delete(spark, f"{store}/{name}")


def compact(spark: SparkSession, store: str, upto_batch: int, vacuum: bool = True) -> None:
    """Fold every batch ``<= upto_batch`` into base version ``upto_batch``.

    Only batches that are committed (older than any batch still in flight) may
    be compacted.  The new base is written completely and must hold as many rows
    as the old base and the folded batches before anything is deleted; ``vacuum``
    then removes older bases and those batches.
    """
    v = latest_base(spark, store)
    if v is not None and v >= upto_batch:
        return
    docs = _documents(spark, store, upto_batch + 1)
    if docs is None:
        return
    new = f"{store}/{BASE}/v={upto_batch}"
    docs.write.mode("overwrite").parquet(new)
    want, got = docs.count(), spark.read.parquet(new).count()
    if want != got:
        delete(spark, new)
        raise RuntimeError(f"compaction of {store} up to batch {upto_batch}: {got} of {want} rows")
    if vacuum:
        vacuum_covered(spark, store)
