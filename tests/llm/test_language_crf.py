import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from txstream.llm import language_crf as crf, textbytes as tb

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_all_label_sequences():
    rng = np.random.default_rng(0)
    count = np.array([3, 1, 0, 4])
    first = np.cumsum(count) - count
    emit = rng.normal(0, 2, (8, 3)).astype(np.float32)
    trans, start = rng.normal(0, 1, (3, 3)), rng.normal(0, 1, 3)
    post, pairs = crf.forward_backward(emit, first, count, trans, start, pairs=True)
    want, want_pairs = np.zeros((8, 3)), np.zeros((3, 3))
    for f, n in zip(first, count):
        total, mine, moved = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for seq in itertools.product(range(3), repeat=int(n)) if n else []:
            s = start[seq[0]] + sum(emit[f + i, y] for i, y in enumerate(seq)) + sum(
                trans[a, b] for a, b in zip(seq, seq[1:]))
            total += np.exp(s)
            for i, y in enumerate(seq):
                mine[i, y] += np.exp(s)
            for a, b in zip(seq, seq[1:]):
                moved[a, b] += np.exp(s)
        if n:
            want[f:f + n] = mine / total
            want_pairs += moved / total
    assert np.allclose(post, want, atol=1e-5) and np.allclose(pairs, want_pairs, atol=1e-5)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    def of(text, word):
        out = []
        for w in tb.scan(pa.array([text]), tb.LETTERS, True):
            f, b = crf.word_features(w)
            for i, (s, e) in enumerate(zip(w.starts, w.ends)):
                if w.data[s:e].tobytes().decode() == word:
                    out.append(f[b[i]:b[i + 1]].tolist())
        return out
    got = of("über x Straße über", "über") + of("über", "über") + of("a1über!", "über")
    assert len(got) == 4 and all(g == got[0] for g in got)
    assert of("ab", "ab")[0] != of("ba", "ba")[0]


def test_code_switched_words():
    en, de = "the cat sat with this and that " * 30, "der hund und die katze sind nicht hier " * 30
    model = crf.fit([en, de] * 10, ["en", "de"] * 10, epochs=3)
    for w in tb.scan(pa.array(["the cat sat with this und die katze sind nicht hier"]), tb.LETTERS, True):
        p = crf.word_probabilities(model, w)
    assert [model.labels[i] for i in p.argmax(1)] == ["en"] * 5 + ["de"] * 6


def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = crf.train(docs)
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "123 !? —"), (None, "the and of"),
                                   (10**6 + 3, "the " * 30_000)], "doc_id long, text string")
    both = docs.select("doc_id", "text", F.lit("x").alias("lang_pred")).unionByName(extra, True)
    got = {r.doc_id: r for r in crf.predict(both, model).collect()}
    assert len(got) == docs.count() + 5
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in langs if got[i].held_out} == set(held)
    assert np.mean([got[i].lang_pred == langs[i] for i in held]) > 0.95
    for i in (10**6, 10**6 + 1, 10**6 + 2):
        assert got[i].lang_pred == "und" and got[i].score == 0
    assert got[10**6 + 3].lang_pred == "en" and not got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert crf.predict(docs, crf.train(docs)).first().lang_pred == "und"
    empty = docs.limit(0)
    assert crf.predict(empty, crf.train(empty)).count() == 0
