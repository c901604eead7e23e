import hashlib
import math

import numpy as np
import pytest

from txstream.llm import centroids


def brute(rows, k=40, rounds=5, size=64, scale=256):
    """Plain loops over the kept rows: (vec_id, cluster, distance), and the centroids."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == size and all(c is not None and math.isfinite(c) for c in x):
            lim = centroids.LIMIT
            kept.append((vec_id, [math.floor(max(-lim, min(lim, c * scale))) for c in x]))
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    cs = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        cs = [[sum(col) // len(groups[i]) for col in zip(*groups[i])] if i in groups else c
              for i, c in enumerate(cs)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), cs


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, x, "extra") for i, x in rows],
                               "vec_id long, embedding array<double>, cluster string")
    want, cs = brute(rows, **{k: v for k, v in options.items()})
    got = centroids.clusters(df.repartition(3), **options).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    total = sum(w[2] for w in want)
    for r in got:
        assert r.inertia == min(total, centroids.LONG_MAX)
        assert r.cluster_inertia == sum(w[2] for w in want if w[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()
    return got


def test_equals_plain_loops_with_ties_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-3, 4, 8) / 256).tolist()) for i in range(150)]
    rows += [(150 + i, rows[i % 5][1]) for i in range(60)] + [rows[7], rows[7]]       # equal vectors, equal rows
    rows += [(900, None), (901, [1.0] * 7), (902, [1.0] * 9), (903, [math.nan] * 8),
             (904, [math.inf] + [0.0] * 7), (905, [None] + [0.0] * 7), (None, [0.5] * 8)]
    check(spark, rows, k=12, rounds=4, size=8)


def test_fewer_vectors_than_centroids_and_large_components(spark):
    rows = [(1, [1e30, -1e30]), (2, [0.004, -0.004]), (3, [-0.001, 7.0]), (3, [-0.001, 7.0])]
    got = check(spark, rows, k=9, rounds=3, size=2)
    assert len(got) == 4


def test_one_group_holds_most_rows_and_no_changes_end_early(spark):
    rows = [(i, [1.0, 1.0]) for i in range(500)] + [(500 + i, [float(i), -4.0]) for i in range(20)]
    check(spark, rows, k=5, rounds=5, size=2)


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert centroids.clusters(df).count() == 0
    assert centroids.clusters(df.limit(0)).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_products_kept_in_the_table_are_the_vectors_products(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    state, cs = centroids.cluster(df, k=7, rounds=3)
    c = np.array(cs)
    for r in state.limit(50).collect():
        assert (np.array(r["v"]) @ c.T).tolist() == r["dots"]
        assert r["norm"] == sum(x * x for x in r["v"])
    assert pytest.approx(len(cs)) == 7
