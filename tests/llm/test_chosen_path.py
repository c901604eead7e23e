from collections import Counter, defaultdict

import numpy as np
import pytest

from txstream.llm import chosen_path as cp
from txstream.llm.decontaminate import words_of


def brute(texts, k=5, t=0.8):
    """Links by comparing all sets that share a shingle, and the connected groups."""
    sets = []
    for x in texts:
        w = words_of(x)
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k
                    else {tuple(w)} if w else set())
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            inverted[g].append(i)
    links, group = [0] * len(sets), list(range(len(sets)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in inverted[g] if j > i).items():
            if both >= t * (len(s) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                group[top(max(i, j))] = top(min(top(i), j))
    return links, [top(i) for i in range(len(sets))]


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    vocab = [f"v{i}" for i in range(500)]
    passage = " ".join(rng.choice(vocab, 30))
    texts = [None, "", "one", "One!", "one two", "one  two", "a b c d", "a b c d", "word " * 4000]
    for _ in range(n):
        base = list(rng.choice(vocab, rng.integers(5, 260)))
        texts.append(" ".join(base))
        for _ in range(rng.integers(0, 5)):       # near copies
            copy = base.copy()
            for at in rng.integers(0, len(copy), max(1, len(copy) // 90)):
                copy[at] = "x" + str(at)
            texts.append(" ".join(copy))
        texts.append(passage + " " + " ".join(rng.choice(vocab, 40)))
    return texts + texts[9:14]


def check(spark, texts, **options):
    ids = [None if i == 12 else i for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, texts)), "doc_id long, text string, picked string")
    got = {r.doc_id: r for r in cp.jaccard_join(df.repartition(3), **options).collect()}
    links, group = brute(texts)
    assert len(got) == len(texts)
    for i, t in zip(ids, texts):
        at = 12 if i is None else i
        assert got[i].n_links == links[at], (i, got[i], links[at])
    by_class = defaultdict(set)
    for i in ids:
        at = 12 if i is None else i
        by_class[group[at]].add(got[i].class_id)
    assert all(len(v) == 1 for k, v in by_class.items() if k != 12)
    assert len({min(v) for v in by_class.values() if None not in v}) == len(
        [v for v in by_class.values() if None not in v])
    kept = sorted(r.doc_id for r in cp.keep_one_of_each(df, **options).collect() if r.doc_id is not None)
    want = {min(j for j in ids if j is not None and group[j] == g) for g in set(group)
            if any(j is not None and group[j] == g for j in ids)}
    assert set(kept) == want and len(kept) == len(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_split_buckets_and_tiles(spark):
    """Tiny limits: buckets are split on all levels and the rest is compared in tiles."""
    check(spark, corpus(3, 25), max_split=4, unit_grams=300, unit_sets=3)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "z"), (2, "z"), (3, None),
                                (3, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_links) for r in cp.jaccard_join(df).collect()) == [
        (1, 1), (1, 1), (2, 1), (2, 1), (3, 0), (3, 0)]
    assert sorted(r.doc_id for r in cp.keep_one_of_each(df).collect()) == [1, 2, 3, 3]
    assert cp.jaccard_join(df.limit(0)).count() == 0


def test_intersections():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(17)]
    got = cp.intersections(sets, cells=64)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(17) for j in range(17)
               if i != j)


def test_large_group_of_different_near_copies(spark):
    """More sets than max_split at production parameters, all of them linked or nearly so."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(100)]
    at = rng.integers(0, 100, 2300)
    texts = [" ".join(base[:p] + [f"x{i}"] + base[p + 1:]) for i, p in enumerate(at)]
    lost = [set(range(max(0, p - 4), min(95, p) + 1)) for p in range(100)]   # shingles a change takes
    both = np.array([[96 - len(a | b) for b in lost] for a in lost])
    linked = both * 1.8 >= 0.8 * 192 - 1e-9
    many = np.bincount(at, minlength=100)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in cp.jaccard_join(df).collect()}
    assert [got[i] for i in range(len(at))] == [int(many[linked[p]].sum()) - 1 for p in at]


def test_pairs_of_hot_shingles_only(spark):
    """All shingles are common, buckets separate: the larger set of a pair contains the other."""
    rng = np.random.default_rng(11)
    rings = [[f"r{j}w{i}" for i in range(700)] for j in range(3)]
    texts = []
    for _ in range(500):
        words = [w for r in rings for a in [rng.integers(0, 700)] for w in (r + r)[a:a + 100]]
        texts += [" ".join(words), " ".join(words[:241])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in cp.jaccard_join(df, max_split=4).collect()}
    links, _ = brute(texts)
    assert min(links) >= 1 and [got[i] for i in range(len(texts))] == links


def test_pairs_count_in_one_unit_and_are_not_listed():
    """A member's row is three numbers, however many partners and units it has."""
    import pyarrow as pa

    grams = np.arange(50, dtype=np.uint64)
    m = [{"cid": i, "copies": i + 1, "units": [4, 7], "grams": grams.tobytes()} for i in range(3)]
    m.append({"cid": 9, "copies": 1, "units": [7], "grams": grams.tobytes()})
    unit_of = {4: m[:3], 7: m}
    batch = pa.RecordBatch.from_pylist([{"unit": u, "m": x} for u, x in unit_of.items()])
    out = pa.Table.from_batches(cp._verify_stage(0.8)([batch])).to_pylist()
    assert [sorted(r) for r in out] == [["cid", "linked_docs", "root"]] * 7
    total = Counter()
    for r in out:
        total[r["cid"]] += r["linked_docs"]
    assert total == {0: 6, 1: 5, 2: 4, 9: 6}


def test_units_inside_others_are_left_out(spark):
    """Full sets travel once for each unit they stand in: a unit whose members all stand in another
    one is not compared again."""
    lists = [[1, 2], [2, 3], [1, 2, 3], [3, 4], [1, 4], [5, 6, 7, 8], [6, 8], [9, 10], list(range(20, 120)),
             list(range(20, 100)), [20, 119]]
    units = spark.createDataFrame(list(enumerate(lists)), "unit long, members array<long>").repartition(3)
    got = {r.unit: list(r.members) for r in cp._largest(units, small=64).collect()}
    # a large unit stays though it stands in another one
    assert got == {i: lists[i] for i in (2, 3, 4, 5, 7, 8, 9)}
    pairs = lambda some: {(a, b) for m in some for a in m for b in m}       # noqa: E731
    assert pairs(got.values()) == pairs(lists)
    assert cp._largest(units.limit(0)).count() == 0
