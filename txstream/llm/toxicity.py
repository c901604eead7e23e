"""Toxicity by two class-conditional Kneser-Ney models of words and word pairs.

Labelled texts outside the held-out part are counted by class, every n-gram once a text.
With absolute discounts D (each class's own, for words and for pairs, from its n-grams seen
once and twice), class c gives a word w after the word h

    P_c(w | h) = max(n_c(h w) - D, 0) / n_c(h .)  +  l_c(h) P_c(w)
    P_c(w)     = max(n_c(w) - D, 0) / n_c(.)      +  l_c    P(w)
    P(w)       = distinct words before w / distinct pairs, over the texts of both classes

where l_c is the probability that the discounts leave, so that rare expressions are
smoothed through backoff counts that the classes share.  Both models are pruned alike: an
n-gram's own counts enter them only if its classes differ clearly (a likelihood-ratio
statistic of ``evidence`` and rates that differ by ``ratio`` at least); all others are left to
the backoff, in both classes, and cancel out.  The log-likelihood ratio of a text is then a
sum of one number for every kept n-gram in it, and everything is counted and summed by
Spark: no table of n-grams reaches the driver, and there is no cap on their number.

The score is a logistic function of the ratio per word and per square root of the words
(the noise of a mean), fitted on a fifth of the labelled texts that the counts leave out,
at most ``sample`` of them.

Defined results: equal texts count once, with the label of most of their copies; repeated
labels of a document count once, as the worse one; null texts are empty, texts without
words have ratio 0; without labels of both kinds the score is the share of toxic ones;
repeated rows are scored alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, functions as F

from txstream.llm import bloom, textbytes as tb
from txstream.session import materialize

U = np.uint64
FOLDS = 5                 # one is kept for the logistic function
UNIT = 1_000_000          # log-ratios are summed as integers of this part, in any order alike
MERGE = 400_000           # partial counts held by a task before they are merged
HISTORY = U(0x6A09E667F3BCC909)


def _distinct(doc: np.ndarray, key: np.ndarray, *more: np.ndarray):
    """Each (document, key) once, and what belongs to it."""
    order = np.lexsort((key, doc))
    d, k = doc[order], key[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    return d[first], k[first], *(m[order][first] for m in more)


def _words(column):
    """Per chunk: rows, distinct (document, word), distinct (document, pair, left, right)."""
    for w in tb.scan(column, tb.ALNUM, True):
        h, doc = w.hashes(), w.docs()
        pair, at = w.grams(h, 2)
        yield (slice(w.first_doc, w.first_doc + w.n_docs), _distinct(doc, h),
               _distinct(doc[at], pair, h[at], h[at + 1]))


class _Sums:
    """Sums of columns by key, merged whenever enough rows have come."""

    def __init__(self, width: int):
        self.parts, self.rows, self.width = [], 0, width

    def add(self, key, *columns) -> None:
        self.parts.append((key, np.stack(columns, 1).reshape(len(key), self.width)))
        self.rows += len(key)

    def merged(self):
        key = np.concatenate([p[0] for p in self.parts] or [np.empty(0, U)])
        x = np.concatenate([p[1] for p in self.parts] or [np.empty((0, self.width), np.int64)])
        order = np.argsort(key, kind="stable")
        key, x = key[order], x[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, int)
        x = np.add.reduceat(x, first) if len(first) else x
        self.parts, self.rows = [(key[first], x)], len(first)
        return key[first], x

    def flush(self, names: list[str], force: bool = False):
        """A batch once more than MERGE keys remain after merging (or by ``force``)."""
        if force or self.rows > MERGE:
            key, x = self.merged()
            if len(key) and (force or len(key) > MERGE // 2):
                self.parts, self.rows = [], 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), *(pa.array(x[:, i].astype(np.int64)) for i in range(self.width))],
                    names=names)


def _word_stage(batches):
    """Arrow stage: toxic, text -> key, t, o (texts with the word), ht, ho (pairs it begins)."""
    tb.release_memory()
    sums = _Sums(4)
    for b in batches:
        label = np.asarray(b.column("toxic"), np.int64)
        for rows, (doc, word), (pdoc, _, left, _) in _words(b.column("text")):
            bad, none = label[rows], np.zeros(len(word), np.int64)
            sums.add(word, bad[doc], 1 - bad[doc], none, none)
            none = np.zeros(len(left), np.int64)
            sums.add(left, none, none, bad[pdoc], 1 - bad[pdoc])
            yield from sums.flush(["key", "t", "o", "ht", "ho"])
    yield from sums.flush(["key", "t", "o", "ht", "ho"], force=True)


def _pair_stage(batches):
    """Arrow stage: toxic, text -> key, t, o (texts with the pair)."""
    tb.release_memory()
    sums = _Sums(2)
    for b in batches:
        label = np.asarray(b.column("toxic"), np.int64)
        for rows, _, (doc, pair, _, _) in _words(b.column("text")):
            bad = label[rows][doc]
            sums.add(pair, bad, 1 - bad)
            yield from sums.flush(["key", "t", "o"])
    yield from sums.flush(["key", "t", "o"], force=True)


def _ends_stage(wanted):
    """Arrow stage: text -> key, left, right of every pair that ``wanted`` passes."""

    def run(batches):
        tb.release_memory()
        pairs = wanted()
        for b in batches:
            for _, _, (_, pair, left, right) in _words(b.column("text")):
                use = np.flatnonzero(bloom.contains(pairs, pair))
                key, first = np.unique(pair[use], return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (key, left[use][first], right[use][first])],
                    names=["key", "left", "right"])

    return run


def _context_stage(wanted):
    """Arrow stage: text -> key, right: the pairs before words that ``wanted`` passes."""

    def run(batches):
        tb.release_memory()
        words = wanted()
        for b in batches:
            for _, _, (_, pair, _, right) in _words(b.column("text")):
                use = np.flatnonzero(bloom.contains(words, right))
                pair, right = pair[use], right[use]
                pair, first = np.unique(pair, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair.view(np.int64)), pa.array(right[first].view(np.int64))], names=["key", "right"])

    return run


def _known_stage(wanted):
    """Arrow stage: rows whose ``h`` may be among the wanted ones."""

    def run(batches):
        words = wanted()
        for b in batches:
            ok = bloom.contains(words, np.asarray(b.column("h"), np.int64).view(U))
            if ok.any():
                yield b.filter(pa.array(ok))

    return run


def _filter(keys: DataFrame, column: str = "key"):
    """Broadcast Bloom filter of about 16 bits a key, 2 MiB at least and 16 MiB at most: a
    fuller one only lets more rows through to the exact join behind it."""
    bits = min(27, max(bloom.BITS, int(16 * max(1, keys.count())).bit_length()))
    shared = keys.sparkSession.sparkContext.broadcast(bloom.build(keys, column, bits))
    return lambda: shared.value


def training_texts(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """toxic, fold, text, doc_id of every distinct labelled text outside the held-out part."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    own = docs.where(~held_out & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("h"), "text")
    one = materialize(own.select("doc_id", "h").join(known, "doc_id").groupBy("h")
                      .agg(F.min("doc_id").alias("doc_id"), F.avg("toxic").alias("share"))
                      .select("h", "doc_id", (F.col("share") >= 0.5).cast("int").alias("toxic")), "toxicity-labels")
    texts = own.mapInArrow(_known_stage(_filter(one, "h")), own.schema).join(one, ["doc_id", "h"])
    return materialize(texts.dropDuplicates(["doc_id", "h"]).select(
        "toxic", F.pmod("h", F.lit(FOLDS)).cast("int").alias("fold"), "text", "doc_id"), "toxicity-texts")


def _discount(n1: int, n2: int) -> float:
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


def _clear(t: str, o: str, n_t: float, n_o: float, evidence: float, ratio: float) -> Column:
    """Whether the classes' rates differ clearly: G2 of a 2 x 2 table, and a factor."""
    t, o = F.col(t).cast("double"), F.col(o).cast("double")
    term = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)        # noqa: E731
    expected = (t + o) / (n_t + n_o)
    g2 = 2 * (term(t, expected * n_t) + term(o, expected * n_o))
    factor = F.abs(F.log((t + 0.5) / (n_t + 1)) - F.log((o + 0.5) / (n_o + 1)))
    return (g2 >= evidence) & (factor >= float(np.log(ratio)))


def weights(texts: DataFrame, evidence: float = 20.0, ratio: float = 2.0,
            toxic_texts: int = 2) -> tuple[DataFrame, float]:
    """key, value (log-ratio in 1/UNIT) of all kept words, histories and pairs; and the ratio
    of every other word.  A kept pair stands in ``toxic_texts`` toxic texts at least (:func:`score`
    asks for none: pairs that mark clean texts are kept as well)."""
    counted = texts.where("fold != 0")
    words = materialize(counted.select("toxic", "text").mapInArrow(
        _word_stage, "key long, t long, o long, ht long, ho long")
        .groupBy("key").agg(*[F.sum(c).alias(c) for c in ("t", "o", "ht", "ho")]), "toxicity-words")
    s = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("t", "o", "ht", "ho")],
                  *[F.count_if(F.col(c) == n).alias(f"{c}{n}") for c in ("t", "o") for n in (1, 2)]).first()
    spark = texts.sparkSession
    if not s["t"] or not s["o"]:
        return spark.createDataFrame([], "key long, value long"), 0.0
    kept = materialize(words.where(_clear("t", "o", s["t"], s["o"], evidence, ratio))
                       .select("key", "t", "o"), "toxicity-kept-words")

    # pairs: all are counted in both classes; those that differ clearly go on
    p = Observation()
    facts = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c) == n).alias(f"{c}{n}") for c in "to" for n in (1, 2)]]
    clear = materialize(
        counted.select("toxic", "text").mapInArrow(_pair_stage, "key long, t long, o long")
        .groupBy("key").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).observe(p, *facts)
        .where(_clear("t", "o", s["ht"], s["ho"], evidence, ratio) & (F.col("t") >= toxic_texts)),
        "toxicity-clear-pairs")
    p = p.get
    ends = counted.select("text").mapInArrow(_ends_stage(_filter(clear)), "key long, left long, right long") \
        .groupBy("key").agg(F.first("left").alias("left"), F.first("right").alias("right"))
    pairs = materialize(clear.join(ends, "key"), "toxicity-kept-pairs")

    # contexts: distinct words before each word that needs its shared probability
    needed = kept.select("key").union(pairs.select("right")).distinct()
    before = (counted.select("text").mapInArrow(_context_stage(_filter(needed)), "key long, right long")
              .distinct().groupBy(F.col("right").alias("key")).agg(F.count(F.lit(1)).alias("before")))
    return _log_ratios(words, kept, pairs, needed.join(before, "key", "left"), s, p)


def _log_ratios(words, kept, pairs, shared, s, p) -> tuple[DataFrame, float]:
    """The two models' log-ratios from their counts (``s`` of words, ``p`` of pairs)."""
    d1 = {c: _discount(s[f"{c}1"], s[f"{c}2"]) for c in "to"}
    # a class without pairs seen once and twice has no discount of its own: it takes the other's
    d2 = {c: _discount(*next(((p[f"{x}1"], p[f"{x}2"]) for x in (c, *"to") if p[f"{x}1"] and p[f"{x}2"]), (0, 0)))
          for c in "to"}
    less = lambda c, d: F.greatest(F.col(c) - d, F.lit(0.0))      # noqa: E731
    mass = kept.agg(*[F.coalesce(F.sum(less(c, d1[c])), F.lit(0.0)).alias(c) for c in "to"]).first()
    left_over = {c: max(1e-9, 1 - mass[c] / s[c]) for c in "to"}
    base = float(np.log(left_over["t"] / left_over["o"]))
    # a word of no pair (it only begins texts) shares the least probability
    common = F.greatest(F.coalesce("before", F.lit(0)), F.lit(0.5)) / float(max(1, p["n"]))
    prob = shared.select("key", common.alias("shared")).join(kept, "key", "left").select(
        "key", F.col("t").isNotNull().alias("own"),
        *[(F.coalesce(less(c, d1[c]), F.lit(0.0)) / float(s[c]) + left_over[c] * F.col("shared")).alias(f"p{c}")
          for c in "to"])
    word_value = prob.where("own").select("key", (F.log(F.col("pt") / F.col("po")) - base).alias("value"))

    # pairs: rows of kept pairs only
    begun = words.select(F.col("key").alias("left"), "ht", "ho")
    rows = pairs.join(begun, "left")
    rows = materialize(rows.select("key", "left", "right", *[
        F.when(F.col(f"h{c}") > 0, less(c, d2[c]) / F.col(f"h{c}")).otherwise(0.0).alias(f"q{c}") for c in "to"]),
        "toxicity-pair-mass")
    lam = rows.groupBy("left").agg(*[F.greatest(1 - F.sum(f"q{c}"), F.lit(1e-9)).alias(f"l{c}") for c in "to"])
    history = F.log(F.col("lt") / F.col("lo"))
    full = rows.join(lam, "left").join(prob.withColumnRenamed("key", "right"), "right")
    pair_value = full.select("key", (F.log((F.col("qt") + F.col("lt") * F.col("pt"))
                                           / (F.col("qo") + F.col("lo") * F.col("po")))
                                     - history - F.log(F.col("pt") / F.col("po"))).alias("value"))
    history_value = lam.select(F.col("left").bitwiseXOR(F.lit(int(HISTORY.view(np.int64)))).alias("key"),
                               history.alias("value"))
    out = word_value.union(pair_value).union(history_value)
    return materialize(out.select("key", F.round(F.col("value") * UNIT).cast("long").alias("value")),
                       "toxicity-weights"), base


def _hit_stage(wanted):
    """Arrow stage: doc_id, held_out, text -> row, doc_id, held_out, n (words), keys."""

    def run(batches):
        tb.release_memory()
        words, row = wanted(), TaskContext.get().partitionId() << 33
        for b in batches:
            for rows, (doc, word), (pdoc, pair, left, _) in _words(b.column("text")):
                n = rows.stop - rows.start
                # a history counts once for every pair it begins
                key = np.concatenate((word, pair, left ^ HISTORY))
                at = np.concatenate((doc, pdoc, pdoc))
                use = np.flatnonzero(bloom.contains(words, key))
                use = use[np.argsort(at[use], kind="stable")]
                cut = np.searchsorted(at[use], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(n)), b.column("doc_id")[rows], b.column("held_out")[rows],
                     pa.array(np.bincount(doc, minlength=n)),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(key[use].view(np.int64)))],
                    names=["row", "doc_id", "held_out", "n", "keys"])
                row += n

    return run


def log_ratios(docs: DataFrame, held_out: Column, model: DataFrame, base: float) -> DataFrame:
    """row, doc_id, held_out, n (distinct words), ratio (log-likelihoods' difference)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = materialize(docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(
        _hit_stage(_filter(model)), f"row long, doc_id {kind}, held_out boolean, n long, keys array<long>"),
        "toxicity-hits")
    sums = (hits.select("row", F.explode("keys").alias("key")).join(model, "key")
            .groupBy("row").agg(F.sum("value").alias("value")))
    return hits.drop("keys").join(sums, "row", "left").withColumn(
        "ratio", F.coalesce("value", F.lit(0)) / float(UNIT) + F.col("n") * F.lit(base)).drop("value")


def _features() -> list[Column]:
    n = F.greatest("n", F.lit(1)).cast("double")
    return [F.col("ratio") / n, F.col("ratio") / F.sqrt(n)]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Bias and weights of a ridge logistic regression (Newton steps)."""
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
    if not len(y) or y.min() == y.max():
        return np.concatenate(([np.log(max(share, 1e-6) / max(1 - share, 1e-6))], np.zeros(x.shape[1])))
    sd = np.maximum(x.std(0), 1e-9)
    z = np.column_stack((np.ones(len(x)), x / sd))
    beta, penalty = np.zeros(z.shape[1]), np.array([1e-6] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty),
                               z.T @ (y - p) - penalty * beta)
        beta += step * min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return np.concatenate(([beta[0]], beta[1:] / sd))


def score(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.7,
          sample: int = 20_000, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    ``held_out`` marks documents whose labels are not used (default: crc32 of doc_id as text
    modulo 3 is 1).
    """
    if held_out is None:
        key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        held_out = F.crc32(key.cast("binary")) % 3 == 1
    texts = training_texts(docs, labels, held_out)
    model, base = weights(texts, **{"toxic_texts": 0, **options})
    found = materialize(log_ratios(docs, held_out, model, base), "toxicity-ratios")
    left = texts.where("fold = 0").select("doc_id", "toxic")
    part = min(1.0, sample / max(1, left.count()))
    chosen = left.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 62)) < int(part * (1 << 62)))
    got = found.join(chosen, "doc_id").groupBy("doc_id").agg(         # sample rows at most, about
        F.max("toxic").alias("y"), *[F.max(f).alias(f"x{i}") for i, f in enumerate(_features())]).toPandas()
    beta = fit_logistic(got[["x0", "x1"]].to_numpy(float).reshape(-1, 2), got["y"].to_numpy(float))
    z = sum((float(w) * f for w, f in zip(beta[1:], _features())), F.lit(float(beta[0])))
    value = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return found.select("doc_id", "held_out", value.alias("score"),
                        (value >= threshold).cast("int").alias("predicted"))
