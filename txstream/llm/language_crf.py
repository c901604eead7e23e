"""Language ID with a linear-chain conditional random field over words.

Every word gets a label.  Its emission scores are sums of learned weights of hashed
features: character bigrams and trigrams with word borders, affixes (the first and last
four bytes) and the word itself (lexicon).  Transitions between neighbouring labels are
learned too.  Forward-backward gives every word its label probabilities; a text's
language is the label with the highest mean probability, which is its score.

The model is fitted by AdaGrad on the exact conditional likelihood, on at most about
``per_language`` whole texts a language, chosen by a hash of doc_id.  For code-switched
text the training texts are cut into short runs of words and strung together in random
order.  Only text is an input of a prediction.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is
everything if nothing can be learned; a null doc_id is neither held out nor learned
from; repeated rows are predicted alike; an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txstream.llm import textbytes as tb

U = np.uint64
BITS = 17
STEP = 2 << 20          # bytes of text worked on at once


def word_features(words: tb.Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of all words, concatenated, and n_words + 1 bounds."""
    n = len(words.starts)
    if n == 0:
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    d = words.data.astype(np.uint32)
    size = words.ends - words.starts
    inside = np.zeros(len(d) + 1, np.int32)
    inside[words.starts] = 1
    inside[words.ends] -= 1
    inside = np.cumsum(inside[:-1]).astype(bool)
    d[~inside] = 0
    padded = np.concatenate(([0, 0], d, [0, 0])).astype(np.uint32)
    # a word's character i and the border after it: size + 1 places each
    place = np.repeat(words.starts - np.concatenate(([0], np.cumsum(size + 1)[:-1])), size + 1) \
        + np.arange(int((size + 1).sum()))
    first = np.repeat(words.starts, size + 1)
    c0 = padded[place + 2]
    c0[place >= np.repeat(words.ends, size + 1)] = 0
    c1 = np.where(place - 1 >= first, padded[place + 1], 0)
    c2 = np.where(place - 2 >= first, padded[place], 0)
    bucket = lambda code, salt: (((code ^ np.uint32(salt)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    two = bucket(c1 << np.uint32(8) | c0, 0x1000000)
    three = bucket(c2 << np.uint32(16) | c1 << np.uint32(8) | c0, 0x2000000)
    head, tail = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    for j in range(4):
        head = head << np.uint32(8) | np.where(j < size, padded[np.minimum(words.starts + j, len(d) - 1) + 2], 0)
        tail = tail << np.uint32(8) | np.where(j < size, padded[np.maximum(words.ends - 1 - j, 0) + 2], 0)
    lexicon = (words.hashes() >> U(64 - BITS)).astype(np.uint32)
    per = 2 * (size + 1) + 3
    bounds = np.concatenate(([0], np.cumsum(per)))
    out = np.empty(int(bounds[-1]), np.int32)
    at = bounds[:-1]
    out[at], out[at + 1], out[at + 2] = bucket(head, 0x3), bucket(tail, 0x7), lexicon
    slot = np.repeat(at + 3 - 2 * np.concatenate(([0], np.cumsum(size + 1)[:-1])), size + 1) \
        + 2 * np.arange(len(place))
    out[slot], out[slot + 1] = two, three
    return out, bounds


def emissions(weights: np.ndarray, feats: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the weight rows of every word's features (blocks bound the memory)."""
    n = len(bounds) - 1
    out = np.empty((n, weights.shape[1]), np.float32)
    for a in range(0, n, 20_000):
        b = min(n, a + 20_000)
        out[a:b] = np.add.reduceat(weights[feats[bounds[a]:bounds[b]]], bounds[a:b] - bounds[a], axis=0)
    return out


def forward_backward(emit: np.ndarray, first: np.ndarray, count: np.ndarray, trans: np.ndarray,
                     start: np.ndarray, pairs: bool = False):
    """Label probabilities of every word; all sequences advance together.

    ``first`` and ``count``: first word and number of words of every sequence.  With
    ``pairs`` also the expected number of every transition.
    """
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    live = lambda t: int(np.searchsorted(-count, -t, side="left"))
    e = np.exp(emit - emit.max(1, keepdims=True)).astype(np.float64) if len(emit) else emit.astype(float)
    a_mat = np.exp(trans)
    alpha = np.empty_like(e)
    steps = int(count.max()) if len(count) else 0
    prev = None
    for t in range(steps):
        m = live(t)
        at = first[:m] + t
        x = e[at] * (np.exp(start) if t == 0 else prev[:m] @ a_mat)
        prev = x / x.sum(1, keepdims=True)
        alpha[at] = prev
    post = np.empty_like(e)
    expected = np.zeros_like(trans)
    beta = None
    for t in range(steps - 1, -1, -1):
        m, after = live(t), live(t + 1)
        at = first[:m] + t
        b = np.ones((m, e.shape[1]))
        if after:
            nxt = e[at[:after] + 1] * beta
            b[:after] = nxt @ a_mat.T
            if pairs:
                joint = alpha[at[:after]][:, :, None] * a_mat[None] * nxt[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        b /= b.sum(1, keepdims=True)
        beta = b
        p = alpha[at] * b
        post[at] = p / p.sum(1, keepdims=True)
    return (post, expected) if pairs else post


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray     # 2^BITS x labels
    trans: np.ndarray
    start: np.ndarray


def fit(texts: list[str], langs: list[str], run: int = 40, row: int = 160, epochs: int = 6,
        batch: int = 64, rate: float = 0.3, ridge: float = 1e-6, seed: int = 5) -> Model:
    """Maximum conditional likelihood on strings of shuffled runs of ``run`` words."""
    labels = sorted(set(langs))
    n_labels = len(labels)
    model = Model(labels, np.zeros((1 << BITS, n_labels), np.float32), np.zeros((n_labels, n_labels)),
                  np.zeros(n_labels))
    feats, bounds, gold, runs = [], [np.zeros(1, np.int64)], [], []
    done, base = 0, 0
    for w in tb.scan(pa.array(texts, pa.string()), tb.LETTERS, True):
        f, b = word_features(w)
        feats.append(f)
        bounds.append(b[1:] + base)
        lab = np.array([labels.index(x) for x in langs[w.first_doc:w.first_doc + w.n_docs]], int)
        gold.append(np.repeat(lab, w.counts))
        for i in range(w.n_docs):
            for a in range(w.bounds[i], w.bounds[i + 1], run):
                runs.append((done + a, done + min(a + run, w.bounds[i + 1])))
        done, base = done + len(w.starts), base + len(f)
    if done == 0 or n_labels < 2:
        return model
    feats, bounds, gold = np.concatenate(feats), np.concatenate(bounds), np.concatenate(gold)
    rng = np.random.default_rng(seed)
    g_w = np.full((1 << BITS, n_labels), 1e-4, np.float32)
    g_t, g_s = np.full_like(model.trans, 1e-4), np.full_like(model.start, 1e-4)
    for _ in range(epochs):
        words = np.concatenate([np.arange(*runs[i]) for i in rng.permutation(len(runs))])
        rows = [words[a:a + row] for a in range(0, len(words), row)]
        for k in range(0, len(rows), batch):
            part = rows[k:k + batch]
            at = np.concatenate(part)
            count = np.array([len(x) for x in part])
            first = np.cumsum(count) - count
            size = bounds[at + 1] - bounds[at]
            index = np.repeat(bounds[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            f = feats[index]
            emit = emissions(model.weights, f, np.concatenate(([0], np.cumsum(size))))
            post, pairs = forward_backward(emit, first, count, model.trans, model.start, pairs=True)
            y = gold[at]
            grad = -post
            grad[np.arange(len(y)), y] += 1
            inner = np.ones(len(y), bool)
            inner[first] = False
            seen = np.zeros_like(model.trans)
            np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
            scale = 1.0 / len(y)
            used, inverse = np.unique(f, return_inverse=True)
            owner = np.repeat(np.arange(len(y)), size)
            step = np.stack([np.bincount(inverse, grad[owner, c], len(used)) for c in range(n_labels)], 1)
            step = step * scale - ridge * model.weights[used]
            g_w[used] += step**2
            model.weights[used] += rate * step / np.sqrt(g_w[used])
            for value, acc, s in ((model.trans, g_t, (seen - pairs) * scale),
                                  (model.start, g_s, grad[first].sum(0) * scale)):
                acc += s**2
                value += rate * s / np.sqrt(acc)
    return model


def has_letter(words: tb.Words, texts: list) -> np.ndarray:
    """Texts with a letter: ASCII ones by their bytes, others by their characters."""
    d = words.data
    ascii_letter = (d >= 0x61) & (d <= 0x7A)
    got = np.diff(np.concatenate(([0], np.cumsum(ascii_letter)))[words.offsets]) > 0
    for i in np.flatnonzero(~got & (words.counts > 0)):
        got[i] = any(c.isalpha() for c in texts[words.first_doc + i] or "")
    return got


def word_probabilities(model: Model, words: tb.Words) -> np.ndarray:
    emit = emissions(model.weights, *word_features(words))
    return forward_backward(emit, words.bounds[:-1], words.counts, model.trans, model.start)


def _predict_stage(get_model):
    def run(batches):
        tb.release_memory()
        model = get_model()
        names = np.array([*model.labels, "und"], object)
        for b in batches:
            texts = b.column("text").to_pylist()
            for w in tb.scan(b.column("text"), tb.LETTERS, True, STEP):
                rows = slice(w.first_doc, w.first_doc + w.n_docs)
                pick, score = np.full(w.n_docs, len(model.labels)), np.zeros(w.n_docs)
                if model.labels:
                    p = word_probabilities(model, w)
                    doc = w.docs()
                    mean = np.stack([np.bincount(doc, p[:, c], w.n_docs) for c in range(p.shape[1])], 1)
                    mean = mean / np.maximum(1, w.counts)[:, None]
                    ok = has_letter(w, texts)
                    pick[ok] = mean[ok].argmax(1)
                    score[ok] = np.clip(mean[ok].max(1), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[rows], b.column("held_out")[rows], pa.array(names[pick], pa.string()),
                     pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2 (null: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = 200) -> Model:
    """A model of the languages outside the held-out part."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id"))).select("doc_id", F.col("lang").cast("string"), "text")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    # one literal a language: texts are filtered where they are read
    rates = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, int((1 << 30) * min(1.0, per_language / n)))])
    part = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) <= rates[F.col("lang")]
    got = known.where(part).select("doc_id", "lang", "text").collect()
    got.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    return fit([r["text"] for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # fixed size for the labels
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        _predict_stage(lambda: shared.value), "doc_id long, held_out boolean, lang_pred string, score double")
