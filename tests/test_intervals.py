import random

import pytest

from txstream.operators import audit, intervals as iv


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def expand(rows):
    return sorted(x for r in rows for x in range(r.lo, r.hi + 1))


def runs(ids):
    ids, out = sorted(set(ids)), []
    for i in ids:
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [tuple(r) for r in out]


def test_ranges_hold_the_same_integers(spark):
    ids = [-9, -8, -7, -1, 0, 1, 2, 15, 16, 17, 31, 32, 64, 64, None, 65]
    got = iv.of_ids(frame(spark, ids), bits=4).collect()
    assert expand(got) == sorted({i for i in ids if i is not None})
    assert all(r.lo >> 4 == r.hi >> 4 == r.b for r in got)        # no range crosses its bucket
    assert sorted((r.lo, r.hi) for r in iv.stitched(iv.of_ids(frame(spark, ids), bits=4), bits=4).collect()) == \
        runs(i for i in ids if i is not None)


@pytest.mark.parametrize("seed", range(3))
def test_union_and_subtract_equal_sets(spark, seed):
    rng = random.Random(seed)
    a = {rng.randint(-60, 60) for _ in range(50)} | set(range(100, 150))
    b = {rng.randint(-60, 60) for _ in range(40)} | set(range(120, 130))
    ra, rb = (iv.of_ids(frame(spark, sorted(x)), bits=3) for x in (a, b))
    assert expand(iv.union(ra, rb).collect()) == sorted(a | b)
    assert expand(iv.subtract(ra, rb).collect()) == sorted(a - b)
    assert sorted((r.lo, r.hi) for r in iv.stitched(iv.subtract(ra, rb), bits=3).collect()) == runs(a - b)
    assert iv.subtract(ra, ra).count() == 0
    assert expand(iv.subtract(ra, rb.limit(0)).collect()) == sorted(a)


def test_fifty_batches_equal_the_full_audit(spark, scratch):
    """Missing ids and gaps after every batch, and the batch's own work only."""
    state, rng, seen = scratch("ranges"), random.Random(4), set()
    everything = list(range(-30, 330))
    rng.shuffle(everything)
    lost = set(everything[::17])
    todo = [i for i in everything if i not in lost]
    produced = iv.of_ids(frame(spark, everything), bits=5)
    for b in range(50):
        part = todo[b * len(todo) // 50:(b + 1) * len(todo) // 50] + rng.sample(sorted(seen), min(2, len(seen)))
        seen |= set(part)
        iv.add_batch(frame(spark, part), b, state, bits=5)
        if b % 7 == 3:
            iv.add_batch(frame(spark, part), b, state, bits=5)        # a replay
        if b % 10 == 9 or b < 2:
            now = iv.ranges_after(spark, state)
            assert expand(now.collect()) == sorted(seen)
            full = frame(spark, sorted(seen))
            assert sorted(map(tuple, iv.gaps(now).collect())) == sorted(map(tuple, audit.audit_gaps(full).collect()))
            assert expand(iv.subtract(produced, now).collect()) == sorted(set(everything) - seen)
    assert expand(iv.subtract(produced, iv.ranges_after(spark, state)).collect()) == sorted(lost)
    assert iv.ranges_after(spark, state).count() <= len(lost) + 14      # gaps and buckets, not ids


def test_empty_sets(spark, scratch):
    state = scratch("none")
    assert iv.ranges_after(spark, state).count() == 0
    iv.add_batch(frame(spark, []), 0, state)
    iv.add_batch(frame(spark, [None]), 1, state)
    assert iv.gaps(iv.ranges_after(spark, state)).count() == 0
    assert iv.stitched(iv.ranges_after(spark, state)).count() == 0


def test_gaps_of_ranges_across_buckets(spark):
    ranges = spark.createDataFrame([(0, 255), (256, 300), (1000, 1023), (5000, 5001), (-40, -20)], "lo long, hi long")
    got = sorted(map(tuple, audit.gaps_between(ranges, bucket_bits=8).collect()))
    assert got == [(-19, -1, 19), (301, 999, 699), (1024, 4999, 3976)]
