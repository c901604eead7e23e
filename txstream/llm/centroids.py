"""K-means on exact integers with an incremental matrix of dot products.

Components are integers (``floor(scale * x)``), so that every sum, dot product and
distance is exact.  Each vector's dot products with all centroids are kept beside it in a
table.  A round changes few components of most centroids; only these changes, the nonzero
components of new minus old centroid, are multiplied with the vectors and added to the
kept products.  The nearest centroid is then the smallest ``|c|^2 - 2 c.v``, and the
distance ``|v|^2`` more.  Sums of the clusters are kept in the same way: only vectors that
changed their cluster are added to one and taken from another.  The first round is no
special case: all centroids begin as zero vectors with products of zero.

Per round the driver sees one centroid table (clusters x components); vectors never move
between tasks: every round reads the table of the one before and writes the next one in
the shared folder, and partial sums are made in the tasks that hold the vectors.

Defined results: vectors of another length, or with a null or non-finite component, are
left out; components beyond +-2^25 are taken as that (distances stay exact longs); sums of
distances beyond a long are the largest long; fewer vectors than centroids give as many
centroids as vectors; centroids may be equal, the smaller number wins; repeated rows are
vectors of their own; a vector without id starts a centroid only when all others do; an
empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txstream.session import scratch_path
from txstream.sources.fs import delete

LIMIT = 1 << 25
LONG_MAX = (1 << 63) - 1

STATE = "vec_id long, v array<int>, norm long, dots array<long>, cluster int, was int, distance long"


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v of every vector of ``size`` finite components."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = (F.size("embedding") == size) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))),
                                                    F.lit(float(-LIMIT)))).cast("int"))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def first_centroids(whole: DataFrame, k: int, order: Column) -> list[list[int]]:
    """Components of the ``k`` first vectors by ``order``, then by components."""
    return [r["v"] for r in whole.orderBy(order.asc_nulls_last(), "v").limit(k).collect()]


def _matrix(column, kind, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), kind).reshape(-1, width)


def _lists(m: np.ndarray, kind) -> pa.Array:
    cut = np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(m.ravel(), kind))


def _round_stage(changes: list[tuple[int, list[int], list[int]]], norms: list[int]):
    """Arrow stage: state -> state after adding the changed components' products.

    ``changes``: centroid, its changed components and their differences.
    """
    size = np.array(norms, np.int64)
    todo = [(c, np.array(at), np.array(diff, np.int64)) for c, at, diff in changes]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("v"), np.int64, len(b.column("v")[0]))
            dots = _matrix(b.column("dots"), np.int64, len(size)).copy()
            for c, at, diff in todo:
                dots[:, c] += v[:, at] @ diff
            far = size - 2 * dots
            cluster = far.argmin(1)              # the first of equal ones
            norm = np.asarray(b.column("norm"), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), b.column("norm"), _lists(dots, pa.int64()),
                 pa.array(cluster, pa.int32()), b.column("cluster"),
                 pa.array(norm + far[np.arange(len(v)), cluster])],
                names=["vec_id", "v", "norm", "dots", "cluster", "was", "distance"])

    return run


def _moved_stage(k: int):
    """Arrow stage: v, cluster, was -> what this task adds to every cluster: its components'
    sums (i = 0, 1, ...) and its count (i = -1)."""

    def run(batches):
        sums, n = None, np.zeros(k, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            v = _matrix(b.column("v"), np.int64, len(b.column("v")[0]))
            sums = np.zeros((k, v.shape[1]), np.int64) if sums is None else sums
            new = np.asarray(b.column("cluster"), np.int64)
            old = np.asarray(b.column("was"), np.int64)
            had = old >= 0
            np.add.at(sums, new, v)
            np.subtract.at(sums, old[had], v[had])
            n += np.bincount(new, minlength=k) - np.bincount(old[had], minlength=k)
        if sums is not None:
            x = np.hstack((n[:, None], sums))
            c, i = np.nonzero(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32()), pa.array(i - 1, pa.int32()), pa.array(x[c, i])],
                names=["cluster", "i", "x"])

    return run


def _moves(state: DataFrame, k: int):
    """(cluster, i, change): at most clusters x components rows reach the driver."""
    parts = (state.where("cluster != was").select("v", "cluster", "was")
             .mapInArrow(_moved_stage(k), "cluster int, i int, x long"))
    return parts.groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256,
            order: Column | None = None):
    """Final state (vec_id, v, norm, dots, cluster, was, distance) and the centroids.

    ``order`` picks the first centroids (default: sha256 of ``2:<vec_id>``).  A round without
    any change of a centroid is the last: all later ones would equal it.
    """
    order = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256) if order is None else order
    whole = whole_vectors(vectors, size, scale)
    new = first_centroids(whole, k, order)
    k = len(new)
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    state = whole.select("vec_id", "v", norm.alias("norm"),
                         F.array_repeat(F.lit(0).cast("long"), k).alias("dots"),
                         F.lit(-1).alias("cluster"))
    centroids = [[0] * size for _ in range(k)]
    sums, counts, path = [[0] * size for _ in range(k)], [0] * k, None
    for step in range(rounds + 1 if k else 0):
        changes = []
        for c in range(k):
            at = [i for i in range(size) if new[c][i] != centroids[c][i]]
            if at:
                changes.append((c, at, [new[c][i] - centroids[c][i] for i in at]))
        if step and not changes:
            break
        centroids = new
        norms = [sum(x * x for x in c) for c in centroids]
        before, path = path, scratch_path(vectors.sparkSession, "dot-products")
        state.select("vec_id", "v", "norm", "dots", "cluster") \
            .mapInArrow(_round_stage(changes, norms), STATE).write.parquet(path)
        state = vectors.sparkSession.read.parquet(path)
        if before:
            delete(vectors.sparkSession, before)       # the new table no longer needs it
        if step == rounds:
            break
        for c, i, x in _moves(state, k):
            if i < 0:
                counts[c] += int(x)
            else:
                sums[c][i] += int(x)
        new = [[s // counts[c] for s in sums[c]] if counts[c] else centroids[c] for c in range(k)]
    return state, centroids


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector."""
    state, centroids = cluster(vectors, **options)
    spark = vectors.sparkSession
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long,"
                                         " inertia long, centroid_sha256 string")
    got = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    far = {r["cluster"]: int(r["s"]) for r in got}           # one row a cluster
    total = min(LONG_MAX, sum(far.values()))
    rows = [(c, min(LONG_MAX, far.get(c, 0)), total,
             hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centroids)]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (state.join(F.broadcast(table), "cluster")        # as many rows as centroids
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
