"""Insert-once document store with steady cost: sorted runs, merged level by level.

Every batch that brings new keys adds one *run*, a folder of Parquet files sorted by key.
Level 0 holds the runs of single batches (``batch=<id>``).  Once a level has ``fan_out`` runs they are merged
into one run of the next level; nothing else is ever rewritten, so a row is written about
``log(store / batch) / log(fan_out)`` times, and there are never more than ``fan_out`` runs
a level.  Runs above level 0 are cut into folders by a hash of the key -- up to ``buckets`` of them, as
many as leave each some rows -- and carry Parquet Bloom filters of it.

A batch looks up only what may hold one of its keys:

* the manifest (one small JSON file a commit) has every run's smallest and largest key, by
  bucket; runs and buckets outside the batch's keys are not opened,
* if the batch has at most ``few`` different keys, they are pushed to the scan as ``IN``
  filters, which Parquet answers from row-group statistics and Bloom filters, and the few
  rows that remain are broadcast to a left anti join (at most one stored row a key); larger
  batches use a shuffle join on the same pruned runs.

Inside one batch the first row per key by ``order`` wins, across batches the earlier commit.
A batch becomes visible with its manifest and is recorded there under its writer (a stream's
checkpoint) and batch id, so a replayed batch is skipped: effectively once.  A folder
without a manifest entry is no part of the store.  Folders that a merge replaced stay until
:func:`vacuum` finds them replaced long enough for every reader to be done.  One process writes
to a store at a time; merges may run beside inserts (:func:`merge_later`).  A store written by
``documents.insert_once`` is taken over with its first batch here.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from txstream.operators.documents import BASE, first_per_key, latest_base
from txstream.sources.fs import (delete, has_data_files, list_dirs, list_names, modification_ms, path_exists,
                                 read_text, write_text)

MANIFEST, LEVELS = "_manifest", "_levels"
RUN, BUCKET = "_run", "_bucket"
BUCKETS, FAN_OUT, FEW, ROWS_PER_FILE, ROWS_PER_BUCKET = 64, 8, 4096, 1_000_000, 1 << 16
KEPT_MANIFESTS = 8
# Spark's setting: the longest IN list that is pushed to Parquet as it is.  There it is a chain of ORs
# that Parquet descends recursively, so longer lists are cut into several of IN_KEYS.
IN_LIMIT, IN_KEYS = "spark.sql.parquet.pushdown.inFilterThreshold", 256

_locks: dict[str, threading.RLock] = {}
_running: dict[str, Future] = {}
_pool = ThreadPoolExecutor(max_workers=2, thread_name_prefix="store-merge")


@dataclass
class Run:
    """One sorted run.  ``spans``: bucket ("" for a whole run of level 0) -> smallest and
    largest key (null if the keys have no order that JSON keeps); ``nulls``: has the null key;
    ``cut``: its number of buckets, a divisor of the store's (0 at level 0)."""

    folder: str
    level: int
    rows: int
    spans: dict[str, list]
    nulls: bool
    cut: int = 0


@dataclass
class Manifest:
    version: int = 0
    key: str = "_id"
    buckets: int = BUCKETS
    schema: str = ""
    runs: list[Run] = field(default_factory=list)
    batches: dict[str, list[list[int]]] = field(default_factory=dict)   # writer -> ranges of ids
    retired: dict[str, int] = field(default_factory=dict)               # replaced folder -> when, in ms

    def committed(self, writer: str, batch_id: int) -> bool:
        return any(a <= batch_id <= b for a, b in self.batches.get(writer, []))

    def commit(self, writer: str, batch_id: int) -> None:
        ranges = sorted([*self.batches.get(writer, []), [batch_id, batch_id]])
        merged = [ranges[0]]
        for a, b in ranges[1:]:
            if a <= merged[-1][1] + 1:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        self.batches[writer] = merged

    def level(self, n: int) -> list[Run]:
        return [r for r in self.runs if r.level == n]

    def full_level(self, fan_out: int) -> int | None:
        """The lowest level with ``fan_out`` runs."""
        levels = sorted({r.level for r in self.runs})
        return next((n for n in levels if len(self.level(n)) >= fan_out), None)


def lock(store: str) -> threading.RLock:
    return _locks.setdefault(store.rstrip("/"), threading.RLock())


def exists(spark: SparkSession, store: str) -> bool:
    return path_exists(spark, f"{store}/{MANIFEST}")


def load(spark: SparkSession, store: str) -> Manifest | None:
    """The newest manifest, or None for a store without a commit."""
    names = [n for n in list_names(spark, f"{store}/{MANIFEST}") if n.endswith(".json") and n[0] != "."]
    if not names:
        return None
    raw = json.loads(read_text(spark, f"{store}/{MANIFEST}/{max(names)}"))
    return Manifest(**{**raw, "runs": [Run(**r) for r in raw["runs"]]})


def _save(spark: SparkSession, store: str, m: Manifest) -> None:
    m.version += 1
    body = json.dumps({**m.__dict__, "runs": [r.__dict__ for r in m.runs]})
    write_text(spark, f"{store}/{MANIFEST}/{m.version:012d}.json", body)
    old = m.version - KEPT_MANIFESTS
    if old > 0:
        delete(spark, f"{store}/{MANIFEST}/{old:012d}.json")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _json_value(v):
    """A smallest or largest key as JSON keeps it in order, else None (no pruning)."""
    return v if isinstance(v, (int, str)) and not isinstance(v, bool) else None


def _overlaps(span: list, wanted: list) -> bool:
    (a, b), (c, d) = span, wanted
    return None in (a, b, c, d) or (a <= d and c <= b)


def touched(m: Manifest, wanted: dict[str, list], nulls: bool) -> list[tuple[Run, list[str]]]:
    """Runs that may hold one of the batch's keys, and the buckets to read of each.

    ``wanted``: bucket -> smallest and largest key of the batch.
    """
    if not wanted:
        return []
    lows, highs = [w[0] for w in wanted.values()], [w[1] for w in wanted.values()]
    whole = [None, None] if None in lows or None in highs else [min(lows), max(highs)]
    out = []
    for r in m.runs:
        if r.level == 0:
            use = [""] if _overlaps(r.spans[""], whole) or (nulls and r.nulls) else []
        else:
            here = [(str(int(b) % r.cut), w) for b, w in wanted.items()]
            use = sorted({b for b, w in here if b in r.spans and _overlaps(r.spans[b], w)}, key=int)
        if use:
            out.append((r, use))
    return out


def _path(store: str, run: Run) -> str:
    return f"{store}/{run.folder}"


def _read(spark: SparkSession, store: str, m: Manifest, runs: list[Run]) -> DataFrame | None:
    """Rows of some runs with their folder's bucket (of that run's number of buckets, 0 at level 0);
    the schema is known, so no file is opened here."""
    schema = T.StructType.fromJson(json.loads(m.schema))
    low = [r for r in runs if r.level == 0]
    high = [r for r in runs if r.level > 0]
    parts = []
    if low:
        parts.append(spark.read.schema(schema).parquet(*[_path(store, r) for r in low])
                     .withColumn(BUCKET, F.lit(0)))
    if high:
        cut = T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        parts.append(spark.read.schema(cut).option("basePath", f"{store}/{LEVELS}")
                     .parquet(*[_path(store, r) for r in high]).drop(RUN))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def stored(spark: SparkSession, store: str, m: Manifest, wanted: dict[str, list] | None,
           nulls: bool = False, keys: list | None = None) -> DataFrame | None:
    """Key column of what may hold the wanted keys (None: of all runs)."""
    if wanted is None:
        df = _read(spark, store, m, m.runs)
        return None if df is None else df.select(m.key)
    parts = []
    found = touched(m, wanted, nulls)
    for kind in (0, 1):
        some = [(r, use) for r, use in found if (r.level > 0) == bool(kind)]
        if not some:
            continue
        df = _read(spark, store, m, [r for r, _ in some])
        if kind:
            df = df.where(F.col(BUCKET).isin(sorted({int(b) for _, use in some for b in use})))
        if keys is not None:
            hit = _in_list(m.key, keys)
            df = df.where(hit | F.col(m.key).isNull() if nulls else hit)
        parts.append(df.select(m.key))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def _in_list(key: str, keys: list) -> Column:
    """``key IN (...)`` as one SQL text: a call a literal would cost more than the lookup.  More than
    ``IN_KEYS`` keys make several lists (the parser balances their ORs)."""
    def literal(v):
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{v}" if v > -(1 << 63) else f"({v + 1}L - 1L)"
    if not keys:
        return F.lit(False)
    lists = [keys[i:i + IN_KEYS] for i in range(0, len(keys), IN_KEYS)]
    if all(isinstance(v, (int, str)) and not isinstance(v, bool) for v in keys):
        return F.expr(" OR ".join(f"`{key}` IN ({', '.join(map(literal, some))})" for some in lists))
    return reduce(Column.__or__, [F.col(key).isin(some) for some in lists])


def _wanted(candidates: DataFrame, key: str, buckets: int, few: int):
    """Per bucket the smallest and largest key of the batch, whether it has the null key, and its
    other keys if there are at most ``few`` (else None; then at most ``buckets`` rows reach the driver)."""
    bucket = bucket_of(key, buckets).alias("b")
    rows = candidates.select(F.col(key).alias("k"), bucket).limit(few + 1).collect()
    if len(rows) <= few:
        by_bucket: dict[str, list] = {}
        for r in rows:
            by_bucket.setdefault(str(r["b"]), []).append(r["k"])
        wanted = {}
        for b, all_keys in by_bucket.items():
            some = [k for k in all_keys if k is not None]
            wanted[b] = [_json_value(min(some)), _json_value(max(some))] if some else [None, None]
        keys = [r["k"] for r in rows if r["k"] is not None]
        return wanted, len(keys) < len(rows), keys
    rows = (candidates.groupBy(bucket).agg(F.min(key).alias("lo"), F.max(key).alias("hi"),
                                           F.count_if(F.col(key).isNull()).alias("nulls")).collect())
    return ({str(r["b"]): [_json_value(r["lo"]), _json_value(r["hi"])] for r in rows},
            any(r["nulls"] for r in rows), None)


def _adopt(spark: SparkSession, store: str, key: str, buckets: int, writer: str) -> Manifest:
    """A new manifest; folders that ``documents.insert_once`` wrote become runs of level 0."""
    m = Manifest(key=key, buckets=buckets)
    base = latest_base(spark, store)
    old = sorted(int(n[6:]) for n in list_dirs(spark, store) if n.startswith("batch=") and n[6:].isdigit())
    old = [b for b in old if (base is None or b > base) and has_data_files(spark, f"{store}/batch={b}")]
    folders = ([f"{BASE}/v={base}"] if base is not None else []) + [f"batch={b}" for b in old]
    for folder in folders:
        df = spark.read.parquet(f"{store}/{folder}")
        m.schema = m.schema or json.dumps(df.schema.jsonValue())
        m.runs.append(Run(folder, 0, df.count(), {"": [None, None]}, True))
    for b in [*range((-1 if base is None else base) + 1), *old]:
        m.commit(writer, b)
    return m


def insert(batch: DataFrame, store: str, batch_id: int, key: str = "_id",
           order=("timestamp", "event_id"), columns=None, writer: str = "",
           buckets: int = BUCKETS, few: int = FEW) -> int:
    """Add the batch's new keys as one run; returns their number (0 for a replayed batch).

    ``writer`` names the source of the batch ids (a stream's checkpoint folder): the same id of
    another writer is another batch.
    """
    spark = batch.sparkSession
    columns = list(columns or [c for c in batch.columns if c != "event_id"])
    conf = spark.conf
    if int(conf.get(IN_LIMIT)) < IN_KEYS:
        conf.set(IN_LIMIT, str(IN_KEYS))
    with lock(store):
        m = load(spark, store)
        if m is None:
            m = _adopt(spark, store, key, buckets, writer)
            _save(spark, store, m)            # from here on a folder without an entry is a failed attempt
        if m.key != key:
            raise ValueError(f"{store} is keyed by {m.key}, not {key}")
        if m.committed(writer, batch_id):
            return 0
    candidates = first_per_key(batch, key, order).select(*columns).persist()
    try:
        existing = None
        if m.runs:
            wanted, nulls, keys = _wanted(candidates, key, m.buckets, few)
            existing = stored(spark, store, m, wanted, nulls, keys)
            if existing is not None and keys is not None:
                existing = F.broadcast(existing)       # at most ``few`` keys, each stored once
        new = candidates
        if existing is not None:
            other = existing.withColumnRenamed(key, "_stored")
            new = candidates.join(other, candidates[key].eqNullSafe(F.col("_stored")), "left_anti")
        name = f"batch={batch_id}"
        if name in m.retired or any(r.folder == name for r in m.runs):      # another writer's batch
            name += f"-{uuid.uuid4().hex[:12]}"
        run = Run(name, 0, 0, {}, False)
        facts = Observation()
        (new.observe(facts, F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"),
                     F.count_if(F.col(key).isNull()).alias("nulls"))
            .sortWithinPartitions(key).write.mode("overwrite").parquet(_path(store, run)))
        got = facts.get
    finally:
        candidates.unpersist()
    run.rows, run.nulls = got["n"], got["nulls"] > 0
    run.spans = {"": [_json_value(got["lo"]), _json_value(got["hi"])]}
    with lock(store):
        m = load(spark, store) or m               # a merge may have committed meanwhile
        if not m.schema:
            m.schema = json.dumps(T.StructType([T.StructField(f.name, f.dataType, True)
                                                for f in new.schema.fields]).jsonValue())
        m.commit(writer, batch_id)
        if run.rows:
            m.runs.append(run)
        _save(spark, store, m)
    if not run.rows:
        delete(spark, _path(store, run))
    return run.rows


def read(spark: SparkSession, store: str, columns=None, schema=None) -> DataFrame:
    """All documents; a store without rows is empty if its schema is known or given."""
    m = load(spark, store)
    df = _read(spark, store, m, m.runs) if m is not None and m.runs else None
    if df is None:
        schema = T.StructType.fromJson(json.loads(m.schema)) if m is not None and m.schema else schema
        if schema is None:
            raise FileNotFoundError(f"no documents under {store}")
        df = spark.createDataFrame([], schema)
    else:
        df = df.drop(BUCKET)
    return df.select(*(columns or df.columns))


def merge(spark: SparkSession, store: str, fan_out: int = FAN_OUT,
          rows_per_file: int = ROWS_PER_FILE, rows_per_bucket: int = ROWS_PER_BUCKET) -> int | None:
    """Merge the lowest full level into one run of the next; its number, or None.

    The new run must hold as many rows as those it replaces before it is committed.
    """
    m = load(spark, store)
    level = m.full_level(fan_out) if m is not None else None
    if level is None:
        return None
    inputs = m.level(level)
    total = sum(r.rows for r in inputs)
    run = Run(f"{LEVELS}/{RUN}={uuid.uuid4().hex[:16]}", level + 1, total, {}, any(r.nulls for r in inputs),
              max(d for d in range(1, m.buckets + 1) if m.buckets % d == 0 and (d == 1 or d * rows_per_bucket <= total)))
    path, per_file = _path(store, run), min(rows_per_file, max(1, total))
    rows = _read(spark, store, m, inputs).withColumn(BUCKET, bucket_of(m.key, run.cut))
    (rows.repartitionByRange(-(-total // rows_per_file), BUCKET, m.key).sortWithinPartitions(BUCKET, m.key)
         .write.partitionBy(BUCKET)
         .option(f"parquet.bloom.filter.enabled#{m.key}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{m.key}", per_file)
         .option("parquet.block.size", 16 << 20)
         .parquet(path))
    got = _read(spark, store, m, [run]).groupBy(BUCKET).agg(
        F.min(m.key).alias("lo"), F.max(m.key).alias("hi"), F.count(F.lit(1)).alias("n")).collect()
    if sum(r["n"] for r in got) != total:
        delete(spark, path)
        raise RuntimeError(f"merging level {level} of {store}: {sum(r['n'] for r in got)} of {total} rows")
    run.spans = {str(r[BUCKET]): [_json_value(r["lo"]), _json_value(r["hi"])] for r in got}
    with lock(store):
        m = load(spark, store)
        gone = {r.folder for r in inputs}
        m.runs = [r for r in m.runs if r.folder not in gone] + [run]
        m.retired.update(dict.fromkeys(gone, int(time.time() * 1000)))
        _save(spark, store, m)
    return level


def run_later(store: str, work) -> None:
    """``work()`` on another thread, one at a time for a store (none is queued behind it); a
    failure there is raised by the store's next call."""
    with lock(store):
        running = _running.get(store)
        if running is not None:
            if not running.done():
                return
            del _running[store]
            running.result()
        _running[store] = _pool.submit(work)


def merge_later(spark: SparkSession, store: str, fan_out: int = FAN_OUT) -> None:
    """Merge full levels on another thread, and delete what was replaced more than an hour ago."""
    m = load(spark, store)
    if m is None or m.full_level(fan_out) is None:
        return

    def go():
        while merge(spark, store, fan_out) is not None:
            pass
        vacuum(spark, store)
    run_later(store, go)


def settle(store: str) -> None:
    """Wait for the work begun by :func:`run_later` and :func:`merge_later`."""
    running = _running.pop(store, None)
    if running is not None:
        running.result()


def vacuum(spark: SparkSession, store: str, older_than_s: float = 3600.0) -> int:
    """Delete folders that merges replaced more than ``older_than_s`` seconds ago, and those of that
    age that no commit names (failed inserts and merges); returns their number.

    The age must exceed the longest read, insert and merge of the store.
    """
    with lock(store):
        m = load(spark, store)
        if m is None:
            return 0
        live, before = {r.folder for r in m.runs}, time.time() * 1000 - older_than_s * 1000
        found = [n for n in list_dirs(spark, store) if n.startswith("batch=")]
        found += [f"{LEVELS}/{n}" for n in list_dirs(spark, f"{store}/{LEVELS}")]
        old = [f for f in found if f not in live
               and m.retired.get(f, modification_ms(spark, f"{store}/{f}")) <= before]
        for f in old:
            delete(spark, f"{store}/{f}")
        if any(f in m.retired for f in old):
            m.retired = {f: t for f, t in m.retired.items() if f not in old}
            _save(spark, store, m)
    return len(old)
