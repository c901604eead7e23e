"""N-gram Jaccard join by the chosen-path method.

Documents are sets of hashed k-word shingles (k = 5; a text of one to four words
is one shingle).  Equal sets form one class, so copies are compared once.  In each
of ``runs`` repetitions a set of n shingles picks every shingle whose random value
is below ``per_set[level] / n``: similar sets pick the same ones.  A picked shingle is a
bucket.  A bucket of more than ``max_split`` sets is split again on shingles picked for
the next level (``levels`` in all) if that separates its sets, that is if fewer than
half of its pairs (estimated on some 256 members) would meet again; the others -- and
whatever is still large after the last level -- are compared exhaustively in tiles of
bounded size.

Recall: of two sets of Jaccard >= t the larger one shares at least a fraction t of its
shingles (t if it contains the other, 2t / (1 + t) at equal sizes), so both pick a common
one with probability p >= 1 - exp(-per_set[level] * t) per run and level.  ``miss`` is the
stated target of this sampling: it misses no pair with a higher probability (the sketch below
adds its own loss).  ``runs`` is the smallest
number that misses a pair by at most miss / 2 on the first level alone; sets with a pick
in a split bucket take part in more runs, until a pair that needs all levels in every run
is missed by at most miss / 2 as well.  A pair of which one set stands in no split bucket
is found by the first runs.  At t = 0.8, miss = 1e-5 and per_set 2, 1.5, 1.5 (p >= 0.798,
0.699, 0.699) that makes 8 and 25 runs.  Pairs are verified on the full sets, so nothing
is reported wrongly.

Before full sets are fetched, each bucket drops members without a partner of
fitting size and a 64-bin one-permutation sketch agreeing in more than
``threshold - 0.25`` of the bins (sets of at most 128 shingles skip the sketch), and small units
inside another one are left out, as all their pairs are compared there.  For a pair at the
threshold that loses 4e-6 (all 64 bins filled) to 2e-5 (52 of them), by the exact binomial, once
for each bucket they share; so a pair of larger sets is missed with at most about 3e-5 in all.

Defined results: a text without words (null, empty) is similar to nothing and a
class of its own; repeated rows are copies; a null doc_id takes part like any
other, the smallest non-null doc_id names a class; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txstream.llm import bloom, textbytes as tb
from txstream.llm.decontaminate import without
from txstream.session import materialize, settled

U = np.uint64
BINS = 64
SKETCH_FROM = 128      # smaller sets are compared without the sketch
LEVEL_TAGS = 256       # a picked value's low bits hold run * levels + level
SAMPLE = 256           # members of a large bucket that tell whether splitting separates it


def shingle_sets(words: tb.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document, concatenated, and bounds."""
    h = words.hashes()
    parts, firsts = [], []
    counts = words.counts
    g, at = words.grams(h, k)
    parts.append(g)
    firsts.append(words.docs()[at])
    for short in range(1, k):
        g, at = words.grams(h, short)
        d = words.docs()[at]
        only = counts[d] == short
        parts.append(g[only])
        firsts.append(d[only])
    g, d = np.concatenate(parts), np.concatenate(firsts)
    if len(parts[0]) != len(g):
        order = np.argsort(d, kind="stable")
        g, d = g[order], d[order]
    cut = np.searchsorted(d, np.arange(words.n_docs + 1))
    out, bounds = [], np.zeros(words.n_docs + 1, np.int64)
    for i in range(words.n_docs):
        x = np.sort(g[cut[i]:cut[i + 1]])
        if len(x) > 1:
            x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        out.append(x)
        bounds[i + 1] = bounds[i] + len(x)
    return (np.concatenate(out) if out else np.empty(0, U)), bounds


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    s = np.zeros(len(values) + 1, U)
    np.cumsum(values, out=s[1:])
    return s[bounds[1:]] - s[bounds[:-1]]


def _signatures(x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (_sums(tb.mix(x ^ U(0xA5A5A5A5A5A5A5A5)), bounds),
            _sums(tb.mix(x + U(0x1234567890ABCDEF)), bounds))


def _sketches(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16 bits of the smallest shingle of every bin (0: empty)."""
    n = len(bounds) - 1
    out = np.zeros((n, BINS), np.uint16)
    d = np.repeat(np.arange(n), np.diff(bounds))
    cell = d * BINS + (x >> U(58)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(x) else []
    out.reshape(-1)[cell[first]] = np.maximum(x[first] & U(0xFFFF), U(1)).astype(np.uint16)
    return out


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                    pa.array(values.view(np.int64)))


def runs_for(miss: float, threshold: float, per_set: tuple[float, ...]) -> int:
    """Runs after which a pair that needs every level of ``per_set`` is missed by at most ``miss``."""
    found = math.prod(1 - math.exp(-c * threshold) for c in per_set)
    return math.ceil(math.log(miss) / math.log1p(-found) - 1e-9)


def _picks(x: np.ndarray, bounds: np.ndarray, runs: range, per_set: tuple[float, ...]) -> pa.Array:
    """Per document the tagged shingles it picks on all levels of ``runs``."""
    n = np.diff(bounds)
    d = np.repeat(np.arange(len(n)), n)
    limits = []
    for c in per_set:
        share = np.minimum(1.0, c / np.maximum(n, 1))
        limit = np.minimum(share * 2.0**64, 2.0**64 - 4096).astype(U)
        limit[share >= 1.0] = U(2**64 - 1)
        limits.append(limit[d])
    vals, docs = [np.empty(0, U)], [np.empty(0, np.int64)]
    for tag in range(runs.start * len(per_set), runs.stop * len(per_set)):
        m = tb.mix(x + U(((tag + 1) * 0x9E3779B97F4A7C15) % 2**64))
        hit = np.flatnonzero(m <= limits[tag % len(per_set)])
        vals.append((m[hit] & U(2**64 - LEVEL_TAGS)) | U(tag))
        docs.append(d[hit])
    v, dd = np.concatenate(vals), np.concatenate(docs)
    order = np.argsort(dd, kind="stable")
    return _lists(v[order], np.searchsorted(dd[order], np.arange(len(n) + 1)))


def _digest_stage(k: int, runs: int, per_set: tuple[float, ...]):
    """Arrow stage: doc_id, text_hash, text -> signature, size, picked shingles, sketch."""

    def run(batches):
        for b in batches:
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                x, bounds = shingle_sets(w, k)
                s1, s2 = _signatures(x, bounds)
                rows = slice(w.first_doc, w.first_doc + w.n_docs)
                sk = _sketches(x, bounds)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[rows], b.column("text_hash")[rows],
                     pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                     pa.array(np.diff(bounds).astype(np.int64)),
                     _picks(x, bounds, range(runs), per_set),
                     pa.array([r.tobytes() for r in sk], pa.binary())],
                    names=["doc_id", "text_hash", "s1", "s2", "n", "picked", "sketch"])

    return tb.trimmed(run)


def _prune_stage(threshold: float):
    """Arrow stage: members of a unit -> those that may have a partner in it."""

    def run(batches):
        for b in batches:
            out = []
            for row in b.column("m"):
                m = row.as_py()
                cid = np.array([x["cid"] for x in m], np.int64)
                n = np.array([x["n"] for x in m], np.int64)
                sk = np.frombuffer(b"".join(x["sketch"] for x in m), np.uint16).reshape(-1, BINS)
                live = np.zeros(len(cid), bool)
                for i in range(len(cid)):
                    ok = (np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i]) - 1e-9)
                    ok[i] = False
                    at = np.flatnonzero(ok)
                    if n[i] > SKETCH_FROM and len(at):
                        a, c = sk[i], sk[at]
                        used = ((a != 0) | (c != 0)).sum(1)
                        same = ((a == c) & (a != 0)).sum(1)
                        at = at[(same >= (threshold - 0.25) * used) | (n[at] <= SKETCH_FROM)]
                    live[i] = len(at) > 0
                out.append(np.sort(cid[live]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], ["members"])

    return tb.trimmed(run)


def intersections(sets: list[np.ndarray], cells: int = 1 << 22) -> np.ndarray:
    """Pairwise intersection sizes of sorted distinct sets, by blocks of shared values."""
    m = len(sets)
    out = np.zeros((m, m), np.float32)
    x = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, inverse, counts = np.unique(x, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    use = shared[inverse]
    col, row = number[inverse[use]], owner[use]
    total, width = int(shared.sum()), max(1, cells // m)
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    for a in range(0, total, width):
        lo, hi = np.searchsorted(col, (a, a + width))
        block = np.zeros((m, min(width, total - a)), np.float32)
        block[row[lo:hi], col[lo:hi] - a] = 1
        out += block @ block.T
    return out


def _verify_stage(threshold: float):
    """Arrow stage: unit members with full sets -> per member the documents it links to.

    A pair that stands in several units counts in the one of the smallest number.
    """

    def run(batches):
        for b in batches:
            cids, roots, linked = [], [], []
            for unit, row in zip(b.column("unit").to_pylist(), b.column("m"), strict=True):
                m = row.as_py()
                if len(m) < 2:
                    continue
                sets = [np.frombuffer(x["grams"], U) for x in m]
                cid = np.array([x["cid"] for x in m], np.int64)
                cop = np.array([x["copies"] for x in m], np.int64)
                n = np.array([len(s) for s in sets], np.float64)
                both = intersections(sets).astype(np.float64)      # counts: exact in both
                link = both * (1 + threshold) >= threshold * (n[:, None] + n[None, :]) - 1e-6
                np.fill_diagonal(link, False)
                root = cid.copy()      # smallest id of the member's component in this unit
                while True:
                    new = np.minimum(root, np.where(link, root[None, :], np.iinfo(np.int64).max)
                                     .min(1))
                    if (new == root).all():
                        break
                    root = new
                before = [np.array([u for u in x["units"] if u < unit], np.int64) for x in m]
                docs = (link & (intersections(before) == 0)) @ cop
                for i in np.flatnonzero(link.any(1)):
                    cids.append(int(cid[i]))
                    roots.append(int(root[i]))
                    linked.append(int(docs[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cids, pa.int64()), pa.array(roots, pa.int64()),
                 pa.array(linked, pa.int64())], names=["cid", "root", "linked_docs"])

    return tb.trimmed(run)


def _active(w: tb.Words, k: int, active: np.ndarray):
    """Sets and signatures of a chunk, and the documents that may be active, one of each set."""
    x, bounds = shingle_sets(w, k)
    s1, s2 = _signatures(x, bounds)
    keep = np.flatnonzero(bloom.contains(active, s1) & (np.diff(bounds) > 0))
    seen, rows = set(), []
    for i in keep:
        if (s1[i], s2[i]) not in seen:
            seen.add((s1[i], s2[i]))
            rows.append(i)
    return x, bounds, s1, s2, rows


def _more_picks_stage(k: int, active: np.ndarray, runs: range, per_set: tuple[float, ...]):
    """Arrow stage: text -> signature and picks of further runs of documents that may be active."""

    def run(batches):
        for b in batches:
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                x, bounds, s1, s2, rows = _active(w, k, active)
                parts = [x[bounds[i]:bounds[i + 1]] for i in rows]
                cut = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s1[rows].view(np.int64)), pa.array(s2[rows].view(np.int64)),
                     _picks(np.concatenate([np.empty(0, U), *parts]), cut, runs, per_set)],
                    names=["s1", "s2", "picked"])

    return tb.trimmed(run)


def _grams_stage(k: int, active: np.ndarray):
    """Arrow stage: text -> signature and full set of the documents that may be active."""

    def run(batches):
        for b in batches:
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                x, bounds, s1, s2, rows = _active(w, k, active)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s1[rows].view(np.int64)), pa.array(s2[rows].view(np.int64)),
                     pa.array([x[bounds[i]:bounds[i + 1]].tobytes() for i in rows], pa.binary())],
                    names=["s1", "s2", "grams"])

    return tb.trimmed(run)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): node, label = smallest node reached.

    Smallest labels spread along the edges, followed by pointer jumping, until
    nothing changes.  Edges carry no order; partial aggregation serves hot nodes.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                       .where("a <> b").distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.first("a"), F.min("b")).alias("label")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("via")))
        step = labels.join(near, "node").select(
            "node", "label", F.least("label", "via").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        new = materialize(step.join(jump, "low", "left").select(
            "node", F.least("low", "next").alias("label"),
            (F.least("low", "next") < F.col("label")).alias("changed")), "cc-labels")
        labels = new.select("node", "label")
        if new.where("changed").limit(1).count() == 0:
            return labels


def _alike(big: DataFrame, picks: DataFrame, level: int) -> DataFrame:
    """Paths of large buckets that the picks of ``level`` would not separate.

    Of some ``SAMPLE`` members all runs' picks are compared, so a run in which
    similar sets happen to pick nothing does not count as separation.
    """
    part = F.pmod(F.xxhash64("cid", F.lit(11)), F.lit(1 << 30)) * F.col("size") < SAMPLE * (1 << 30)
    sample = materialize(big.where(part).select("path", "cid"), "bucket-samples")
    own = picks.where(F.col("level") == level).select("cid", "run", "t")
    meet = (sample.join(own, "cid").groupBy("path", "t").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("path").agg(F.sum(F.expr("c * (c - 1)")).alias("met")))
    pairs = sample.groupBy("path").agg(F.expr("count(1) * (count(1) - 1)").alias("pairs"))
    return pairs.join(meet, "path", "left").crossJoin(own.agg(F.countDistinct("run").alias("runs"))).where(
        "2 * coalesce(met, 0) >= runs * pairs").select("path")


def _buckets(classes: DataFrame, levels: int, max_split: int):
    """Buckets to be compared exhaustively (cid, path, size, grams), and the cid in split ones."""
    tag = F.col("t").bitwiseAND(LEVEL_TAGS - 1)
    picks = classes.select("cid", "n", F.explode("picked").alias("t")).select(
        "cid", "n", "t", (tag % levels).alias("level"), F.floor(tag / levels).alias("run"))
    members = picks.where("level = 0").select("cid", "n", F.col("t").alias("path"), "run")
    ready, split = [], None
    for level in range(levels):
        sizes = (members.groupBy("path").agg(F.count(F.lit(1)).alias("size"),
                                             F.sum("n").alias("grams"))
                 .where("size >= 2"))
        members = members.join(sizes, "path")
        if level == levels - 1:
            ready.append(members)
            break
        # a bucket of more sets than max_split is split on the next level's picks
        ready.append(members.where(F.col("size") <= max_split))
        big = materialize(members.where(F.col("size") > max_split), "big-buckets")
        if big.limit(1).count() == 0:
            break
        alike = materialize(_alike(big, picks, level + 1), "alike-buckets")
        ready.append(big.join(alike, "path", "left_semi"))
        big = big.join(alike, "path", "left_anti").select("cid", "path", "run", "n")
        if level == 0:
            split = materialize(big.select("cid").distinct(), "split-members")
        nxt = picks.where(F.col("level") == level + 1).select("cid", "run", "t")
        members = materialize(big.join(nxt, ["cid", "run"]).select(
            "cid", "n", F.xxhash64("path", "t").alias("path"), "run"), "split-buckets")
    return ready, split


def _units(ready: list[DataFrame], unit_grams: int, unit_sets: int):
    """Lists of class ids to be compared exhaustively; every list is bounded in size."""
    lists = []
    for m in ready:
        blocks = F.greatest(F.ceil(F.col("grams") / unit_grams), F.ceil(F.col("size") / unit_sets))
        m = m.select("cid", "path", blocks.cast("int").alias("nb"))
        m = m.withColumn("blk", F.pmod(F.xxhash64("cid", F.lit(7)), F.col("nb")).cast("int"))
        m = m.select("cid", "path", "blk",
                     F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
        lists.append(m.groupBy("path", F.least("blk", "other").alias("i"),
                               F.greatest("blk", "other").alias("j"))
                     .agg(F.array_sort(F.collect_set("cid")).alias("members")))
    out = lists[0]
    for x in lists[1:]:
        out = out.union(x)
    return out.where("size(members) >= 2").select("members").distinct()


def _largest(units: DataFrame, small: int = 64) -> DataFrame:
    """Units (unit, members) without those of at most ``small`` members that all stand in another one:
    every pair of theirs is compared there."""
    member = units.select("unit", F.explode("members").alias("cid"), (F.size("members") <= small).alias("few"))
    lists = member.groupBy("cid").agg(F.collect_list("unit").alias("units"))
    inside = (member.where("few").join(lists, "cid").groupBy("unit").agg(F.collect_list("units").alias("m"))
              .where(F.expr("size(aggregate(m, m[0], (a, x) -> array_intersect(a, x))) > 1")).select("unit"))
    return units.join(inside, "unit", "left_anti")


def jaccard_join(docs: DataFrame, threshold: float = 0.8, k: int = 5, miss: float = 1e-5,
                 per_set: tuple[float, ...] = (2.0, 1.5, 1.5), max_split: int = 2048,
                 unit_grams: int = 400_000, unit_sets: int = 2048) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id, n_links, copies, is_first.

    ``class_id`` is the smallest doc_id of the connected group, ``n_links`` the
    number of other documents of Jaccard >= threshold (copies included),
    ``is_first`` marks the rows of the document that stands for its group.  ``miss``
    bounds the probability that a pair is missed.
    """
    levels = len(per_set)
    runs, all_runs = (runs_for(miss / 2, threshold, c) for c in (per_set[:1], per_set))
    if all_runs * levels > LEVEL_TAGS:
        raise ValueError(f"{all_runs} runs of {levels} levels are more than {LEVEL_TAGS}")
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = materialize(base.mapInArrow(
        _digest_stage(k, runs, per_set),
        "doc_id long, text_hash long, s1 long, s2 long, n long, picked array<long>,"
        " sketch binary").withColumn("uid", F.monotonically_increasing_id()), "cp-rows")
    worded = rows.where("n > 0")
    classes = materialize(worded.groupBy("s1", "s2").agg(
        F.min("uid").alias("cid"), F.count(F.lit(1)).alias("copies"),
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"),
        F.first("picked").alias("picked"), F.first("sketch").alias("sketch")), "cp-classes")

    numbered = lambda df: materialize(
        df.withColumn("unit", F.monotonically_increasing_id()), "cp-units")

    def candidates():
        ready, split = _buckets(classes, levels, max_split)
        if split is not None and split.limit(1).count():
            hot = materialize(classes.join(split, "cid").select("cid", "n", "s1", "s2"), "cp-hot")
            hot_words = docs.sparkSession.sparkContext.broadcast(bloom.build(hot, "s1"))
            more = materialize(docs.select("text").mapInArrow(
                lambda it: _more_picks_stage(k, hot_words.value, range(runs, all_runs), per_set)(it),
                "s1 long, s2 long, picked array<long>")
                .groupBy("s1", "s2").agg(F.first("picked").alias("picked"))
                .join(hot, ["s1", "s2"]).select("cid", "n", "picked"), "cp-more-picks")
            ready += _buckets(more, levels, max_split)[0]
        units = numbered(_units(ready, unit_grams, unit_sets))
        member = F.struct("cid", "n", "sketch").alias("x")
        pruned = (units.select("unit", F.explode("members").alias("cid"))
                  .join(classes.select("cid", "n", "sketch"), "cid")
                  .groupBy("unit").agg(F.collect_list(member).alias("m"))
                  .select("m").mapInArrow(_prune_stage(threshold), "members array<long>")
                  .where("size(members) >= 2").distinct())
        return _largest(numbered(pruned))

    units = settled(docs.sparkSession, candidates, "cp-units")      # the buckets' tables go here
    members = units.select("unit", F.explode("members").alias("cid"))
    active = classes.join(members.groupBy("cid").agg(F.collect_list("unit").alias("units")),
                          "cid").select("cid", "s1", "s2", "copies", "units")
    words = docs.sparkSession.sparkContext.broadcast(bloom.build(active, "s1"))
    sets = (docs.select("text").mapInArrow(
        lambda it: _grams_stage(k, words.value)(it), "s1 long, s2 long, grams binary")
        .groupBy("s1", "s2").agg(F.first("grams").alias("grams"))
        .join(active, ["s1", "s2"]).select("cid", "copies", "units", "grams"))
    found = materialize(
        members.join(sets, "cid").groupBy("unit")
        .agg(F.collect_list(F.struct("cid", "copies", "units", "grams")).alias("m"))
        .select("unit", "m").mapInArrow(_verify_stage(threshold),
                                        "cid long, root long, linked_docs long"),
        "cp-links")
    links = found.groupBy("cid").agg(F.sum("linked_docs").alias("linked_docs"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    labelled = (classes.select("s1", "s2", "cid", "copies", "first_id")
                .join(links, "cid", "left")
                .join(groups.withColumnRenamed("node", "cid"), "cid", "left")
                .withColumn("label", F.coalesce("label", "cid")))
    names = labelled.groupBy("label").agg(
        F.min("first_id").alias("class_id"),
        F.expr("min_by(cid, struct(first_id is null, first_id, cid))").alias("chief"))
    labelled = labelled.join(names, "label").select(
        "s1", "s2", "copies", "class_id", "first_id", (F.col("cid") == F.col("chief")).alias("lead"),
        (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links"))
    wordless = F.col("copies").isNull()
    return rows.join(labelled, ["s1", "s2"], "left").select(
        "doc_id", "text_hash",
        F.when(wordless, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        (wordless | (F.col("lead") & F.col("doc_id").eqNullSafe(F.col("first_id"))))
        .alias("is_first"))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document left of every near-duplicate group.

    The document with the smallest doc_id stays; rows that repeat it (same doc_id
    and text) are one row.  Texts without words all stay.  Columns of any name pass;
    texts are not shuffled while the rejected documents are few enough to be broadcast
    (:func:`without`).
    """
    # of the join's tables only the verdict stays
    verdict = settled(docs.sparkSession, lambda: jaccard_join(docs, **options).groupBy("doc_id", "text_hash").agg(
        F.max("is_first").alias("_first"), F.count(F.lit(1)).alias("_rows"),
        F.max("copies").alias("_copies")), "cp-verdict")
    out = F.coalesce(F.col("_first"), F.lit(True))
    kept = without(docs, verdict.where(~out))
    again = (verdict.where(out & (F.col("_rows") > 1) & (F.col("_copies") > 1))
             .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th")))
    if again.limit(1).count() == 0:
        return kept
    rows = kept.select(F.struct(*[kept[c] for c in kept.columns]).alias("_row")).select(
        "_row", F.col("_row.doc_id").alias("_key"), F.xxhash64("_row.text").alias("_hash"))
    same = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_th"))
    repeated = rows.join(again, same, "left_semi").dropDuplicates(["_key", "_hash"])
    return rows.join(again, same, "left_anti").unionByName(repeated).select("_row.*")
