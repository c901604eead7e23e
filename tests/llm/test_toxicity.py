import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txstream.llm import toxicity as tx

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text):
    w = words_of(text)
    return set(w), {(a, b) for a, b in zip(w, w[1:])}


def clear(t, o, nt, no, evidence, ratio):
    e = (t + o) / (nt + no)
    g2 = 2 * sum(x * math.log(x / (e * n)) if x else 0.0 for x, n in ((t, nt), (o, no)))
    factor = abs(math.log((t + .5) / (nt + 1)) - math.log((o + .5) / (no + 1)))
    return g2 >= evidence and factor >= math.log(ratio)


def brute_ratios(training, texts, evidence, ratio):
    """training: (toxic, text) -> log-ratio of every text, from the two models' probabilities."""
    uni, bi, hist = (defaultdict(lambda: [0, 0]) for _ in range(3))
    contexts = defaultdict(set)
    for toxic, text in training:
        ws, ps = grams(text)
        c = 0 if toxic else 1
        for w in ws:
            uni[w][c] += 1
        for a, b in ps:
            bi[a, b][c] += 1
            hist[a][c] += 1
            contexts[b].add(a)
    total = [sum(v[c] for v in uni.values()) for c in (0, 1)]
    ptotal = [sum(v[c] for v in hist.values()) for c in (0, 1)]
    types = sum(map(len, contexts.values()))
    disc = [tx._discount(sum(v[c] == 1 for v in uni.values()), sum(v[c] == 2 for v in uni.values())) for c in (0, 1)]
    d2 = tx._discount(sum(v[0] == 1 for v in bi.values()), sum(v[0] == 2 for v in bi.values()))
    kept = {w for w, (t, o) in uni.items() if clear(t, o, *total, evidence, ratio)}
    pairs = {p for p, (t, o) in bi.items() if t >= 2 and clear(t, o, *ptotal, evidence, ratio)}
    lam = [1 - sum(max(uni[w][c] - disc[c], 0) for w in kept) / total[c] for c in (0, 1)]

    def p1(w, c):
        own = max(uni[w][c] - disc[c], 0) / total[c] if w in kept else 0
        return own + lam[c] * max(len(contexts[w]), .5) / types

    def q(a, b, c):
        return max(bi[a, b][c] - d2, 0) / hist[a][c] if (a, b) in pairs and hist[a][c] else 0

    def lam2(a, c):
        return 1 - sum(q(x, y, c) for x, y in pairs if x == a)

    begins = {a for a, _ in pairs}
    out = []
    for text in texts:
        ws, ps = grams(text)
        r = 0.0
        for w in ws:      # a word that is not kept has the same shared probability in both
            r += math.log(p1(w, 0) / p1(w, 1)) if w in kept else math.log(lam[0] / lam[1])
        for a, b in ps:
            if a in begins:
                r += math.log(lam2(a, 0) / lam2(a, 1))
            if (a, b) in pairs:
                full = [q(a, b, c) + lam2(a, c) * p1(b, c) for c in (0, 1)]
                r += (math.log(full[0] / full[1]) - math.log(lam2(a, 0) / lam2(a, 1))
                      - math.log(p1(b, 0) / p1(b, 1)))
        out.append(r)
    return out, kept, pairs, types


def corpus(n=400):
    rng = np.random.default_rng(5)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "été", "zeta", "eta2", "theta", "iota", "kappa"]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        w = list(rng.choice(vocabulary, int(rng.integers(3, 14))))
        if toxic and rng.random() < .9:
            w.insert(int(rng.integers(0, len(w))), "rude")
            if rng.random() < .6:
                w += ["get", "lost"]
        elif rng.random() < .15:
            w += ["get", "well"]
        rows.append((toxic, " ".join(w) + f" u{i}."))
    return rows


def test_log_ratios_equal_the_two_models(spark, monkeypatch):
    rows = corpus()
    texts = spark.createDataFrame([(t, 1, x, i) for i, (t, x) in enumerate(rows)],
                                  "toxic int, fold int, text string, doc_id long").repartition(3)
    probe = [x for _, x in rows[:60]] + ["", None, "rude", "You RUDE rude, get lost. get LOST!", "nothing known here",
                                         "get", "lost get", "a" * 5000 + " rude " * 300]
    model, base = tx.weights(texts, evidence=8.0, ratio=1.5)
    docs = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r for r in tx.log_ratios(docs, F.lit(False), model, base).collect()}
    want, kept, pairs, types = brute_ratios(rows, probe, 8.0, 1.5)
    assert "rude" in kept and ("get", "lost") in pairs and types > 400
    for i, w in enumerate(want):
        # the number of pair types is an approximate count: it shifts shared probabilities a little
        assert got[i].ratio == pytest.approx(w, abs=0.03 * (1 + len(words_of(probe[i])))), probe[i]
        assert got[i].n == len(set(words_of(probe[i])))


def test_pairs_of_both_classes_are_counted_whole(spark):
    """A pair of clean texts alone is kept, the number of pair types is exact, and each class has
    its own discount; the words of pairs are alike in both classes, so words alone tell nothing."""
    def rows(toxic, n, fixed):
        return [(toxic, f"{fixed} " + " ".join(f"x{toxic}{i}a{j} y{toxic}{i}a{j}" for j in range(3))) for i in range(n)]
    # pairs seen twice: some in toxic texts, more in clean ones
    data = (rows(1, 60, "good bye then") + rows(0, 60, "bye good then") + [(1, "m n")] * 2
            + [(0, f"c{i} d{i}") for i in range(9)] * 2)
    texts = spark.createDataFrame([(t, 1, x, i) for i, (t, x) in enumerate(data)],
                                  "toxic int, fold int, text string, doc_id long").repartition(3)
    model, base = tx.weights(texts, evidence=8.0, ratio=1.5, toxic_texts=0)
    probe = ["good bye", "bye good", "then"]
    docs = spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string")
    got = {r.doc_id: r.ratio for r in tx.log_ratios(docs, F.lit(False), model, base).collect()}

    bi, begun, before = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), defaultdict(set)
    uni = defaultdict(lambda: [0, 0])
    for toxic, text in data:
        ws, ps = grams(text)
        for w in ws:
            uni[w][1 - toxic] += 1
        for a, b in ps:
            bi[a, b][1 - toxic] += 1
            begun[a][1 - toxic] += 1
            before[b].add(a)
    total = [sum(v[c] for v in begun.values()) for c in (0, 1)]
    kept = {p for p, v in bi.items() if clear(*v, *total, 8.0, 1.5)}
    assert {("good", "bye"), ("bye", "good")} <= kept and bi["bye", "good"][0] == 0
    assert not any(clear(*uni[w], *[sum(v[c] for v in uni.values()) for c in (0, 1)], 8.0, 1.5) for w in uni)
    disc = [tx._discount(*(sum(v[c] == n for v in bi.values()) for n in (1, 2))) for c in (0, 1)]
    assert abs(disc[0] - disc[1]) > 0.02

    def q(a, b, c):
        return max(bi[a, b][c] - disc[c], 0) / begun[a][c] if (a, b) in kept and begun[a][c] else 0

    def lam(a, c):
        return max(1e-9, 1 - sum(q(x, y, c) for x, y in kept if x == a))
    for i, (a, b) in enumerate([("good", "bye"), ("bye", "good")]):
        shared = len(before[b]) / len(bi)
        want = 2 * base + math.log((q(a, b, 0) + lam(a, 0) * shared) / (q(a, b, 1) + lam(a, 1) * shared))
        assert got[i] == pytest.approx(want, abs=1e-5)
    assert got[2] == pytest.approx(base)


def test_held_out_toxic_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = tx.score(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    held = got[got.held_out]
    bad, fine = held[held.toxic == 1], held[held.toxic == 0]
    # some labels are wrong, and one language has few toxic texts here
    assert bad.predicted.mean() > 0.8 and fine.predicted.mean() < 0.01
    assert ((got.score >= 0.7) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_copies_count_once_and_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, "same text rude", "k") for i in range(300)] + [(1000 + i, f"kind words {i}", "k") for i in range(200)]
        + [(None, "same text", "k"), (5000, None, "k"), (5001, "", "k"), (5001, "", "k"), (1000, "kind words 0", "k")],
        "doc_id long, text string, key string")
    labels = spark.createDataFrame([(i, int(i < 300), None) for i in range(1200)] + [(None, 1, None), (7, None, 1), (7, 0, 0)],
                                   "doc_id long, toxic int, h int")
    held = F.lit(False)
    texts = tx.training_texts(docs, labels, held).collect()
    assert len(texts) == 201 and sum(r.toxic for r in texts) == 1
    out = tx.score(docs, labels).collect()
    assert len(out) == 505 and all(0 <= r.score <= 1 for r in out)
    assert sum(r.doc_id is None for r in out) == 1


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = tx.score(docs, none).collect()
    assert len(got) == 2 and {r.predicted for r in got} == {0}
    assert tx.score(docs.limit(0), none).count() == 0


def test_counts_of_partial_sums_are_whole(monkeypatch):
    monkeypatch.setattr(tx, "MERGE", 50)
    sums, want = tx._Sums(2), Counter()
    rng, got = np.random.default_rng(1), Counter()
    for _ in range(40):
        key = rng.integers(0, 200, 30).astype(np.uint64)
        want.update(key.tolist())
        sums.add(key, np.ones(30, np.int64), np.zeros(30, np.int64))
        for b in sums.flush(["key", "a", "b"]):
            got.update(dict(zip(b.column("key").to_pylist(), b.column("a").to_pylist())))
    for b in sums.flush(["key", "a", "b"], force=True):
        for k, n in zip(b.column("key").to_pylist(), b.column("a").to_pylist()):
            got[k] += n
    assert got.total() == want.total()
