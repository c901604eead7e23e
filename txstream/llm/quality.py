"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic model, fitted on at most ``sample`` labelled documents, gives every text a
probability to be good: of quality and not toxic.  Sums of these probabilities per
path and host (one grouped aggregation) give posteriors: a host is shrunk towards the
global mean and a path towards its host by the strengths that the spread between
hosts and between paths warrants, so that sparse sites stay near their prior.  A
document's score adds the log-odds of its own evidence and of its path, without its
own share in the path.  ``documents`` has no address; its host is ``source`` and its
path ``(source, lang)`` -- both are parameters.

The model sees hashed words and word beginnings (presence, 2^18 buckets) that differ
clearly between the classes, and shape: shares of signs, digits, capitals and repeated words, word
and line lengths.

Defined results: a text without words (null, empty) has probability 0 and is not kept;
null hosts and paths are sites of their own; repeated labels of a document count once,
as the worse one; without labels of both kinds that part of the model is constant
(good); repeated rows are scored alike; an empty table gives no row; other columns,
also of clashing names, pass through ``filter_quality`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from txstream.llm import textbytes as tb
from txstream.session import materialize

U = np.uint64
BUCKETS = 1 << 18
N_SHAPE = 9
PREFIXES = (4, 5)       # bytes
EPS = 1e-6


def shape_of(words: tb.Words, raw: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Shape features of every document: one row a document."""
    n = words.n_docs
    off = words.offsets
    size = np.maximum(1, np.diff(off)).astype(float)
    sums = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[off])
    upper = (raw >= 0x41) & (raw <= 0x5A)
    digit = (raw >= 0x30) & (raw <= 0x39)
    lower = (raw >= 0x61) & (raw <= 0x7A)
    plain = np.isin(raw, np.frombuffer(b" \n,.'\"-?!", np.uint8))
    sign = ~(upper | digit | lower | plain | (raw >= 0x80))
    count = np.maximum(1, words.counts).astype(float)
    doc = words.docs()
    again = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    out = np.empty((n, N_SHAPE))
    out[:, 0] = np.log1p(words.counts)
    out[:, 1] = np.sqrt(sums(sign) / size)
    out[:, 2] = np.sqrt(sums(digit) / size)
    out[:, 3] = np.sqrt(sums(upper) / size)
    out[:, 4] = np.sqrt(np.bincount(doc[again], minlength=n) / count)
    out[:, 5] = np.bincount(doc, (words.ends - words.starts).astype(float), n) / count
    out[:, 6] = np.log1p(size / (1.0 + sums(raw == 0x0A)))
    out[:, 7] = np.sqrt(sums(raw == 0x21) / size)
    out[:, 8] = sums(upper) / np.maximum(1, sums(upper | lower))
    return out


def _pairs(doc: np.ndarray, h: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    bucket = (h & U(BUCKETS - 1)).astype(np.int64)
    if wanted is not None:
        use = np.flatnonzero(wanted[bucket])
        doc, bucket = doc[use], bucket[use]
    return doc * BUCKETS + bucket


def features(column, wanted: np.ndarray | None = None):
    """Per chunk: words, (document, bucket) pairs without repeats, shape.

    ``wanted`` (a flag per bucket) leaves out pairs of other buckets.
    """
    raw, offsets = tb.buffers(column)
    for w in tb.scan(column, tb.ALNUM, True):
        h, doc = w.hashes(), w.docs()
        pairs = [_pairs(doc, h, wanted)]
        for n in PREFIXES:      # words of one stem share these
            longer = np.flatnonzero(w.ends - w.starts > n)
            stem = replace(w, starts=w.starts[longer], ends=w.starts[longer] + n).hashes()
            pairs.append(_pairs(doc[longer], tb.mix(stem + U(n)), wanted))
        pair = np.unique(np.concatenate(pairs))
        part = raw[offsets[w.first_doc]:offsets[w.first_doc + w.n_docs]]
        yield w, pair // BUCKETS, pair % BUCKETS, shape_of(w, part, h)


@dataclass
class Head:
    """One logistic model: bias, weights of buckets, weights of standardized shape."""

    bias: float
    buckets: np.ndarray
    shape: np.ndarray
    mean: np.ndarray
    sd: np.ndarray

    def log_odds(self, n_docs, doc, bucket, shape) -> np.ndarray:
        z = self.bias + np.clip((shape - self.mean) / self.sd, -5, 5) @ self.shape
        return z + np.bincount(doc, self.buckets[bucket], n_docs)


def fit(doc: np.ndarray, bucket: np.ndarray, shape: np.ndarray, y: np.ndarray,
        most_buckets: int = 400, z_min: float = 5.0, ridge: float = 0.3) -> Head:
    """Ridge logistic regression on the words that differ clearly between the classes."""
    n, weights = len(y), np.zeros(BUCKETS)
    mean = shape.mean(0) if n else np.zeros(N_SHAPE)
    sd = np.maximum(shape.std(0), 1e-3) if n else np.ones(N_SHAPE)
    if n == 0 or y.min() == y.max():
        return Head(30.0 if n == 0 or y[0] else -30.0, weights, np.zeros(N_SHAPE), mean, sd)
    pos = np.bincount(bucket[y[doc] == 1], minlength=BUCKETS)
    neg = np.bincount(bucket[y[doc] == 0], minlength=BUCKETS)
    n1, n0 = int(y.sum()), int(n - y.sum())
    share = (pos + neg) / n
    z = (pos / n1 - neg / n0) / np.sqrt(np.maximum(share * (1 - share), 1 / n) * (1 / n1 + 1 / n0))
    chosen = np.argsort(-np.abs(z), kind="stable")[:most_buckets]
    chosen = chosen[(np.abs(z[chosen]) >= z_min) & ((pos + neg)[chosen] >= 5)]
    column = np.full(BUCKETS, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((n, 1 + N_SHAPE + len(chosen)))
    x[:, 0] = 1
    x[:, 1:1 + N_SHAPE] = np.clip((shape - mean) / sd, -5, 5)
    use = column[bucket] >= 0
    x[doc[use], 1 + N_SHAPE + column[bucket[use]]] = 1
    beta, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - penalty * beta
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    weights[chosen] = beta[1 + N_SHAPE:]
    return Head(float(beta[0]), weights, beta[1:1 + N_SHAPE], mean, sd)


def _feature_stage(batches):
    for b in batches:
        for w, doc, bucket, shape in features(b.column("text")):
            cut = np.searchsorted(doc, np.arange(w.n_docs + 1)).astype(np.int32)
            rows = slice(w.first_doc, w.first_doc + w.n_docs)
            yield pa.RecordBatch.from_arrays(
                [b.column("quality")[rows], b.column("toxic")[rows],
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(bucket.astype(np.int32))),
                 pa.array(list(shape), pa.list_(pa.float64()))],
                names=["quality", "toxic", "buckets", "shape"])


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> tuple[Head, Head]:
    """Heads for quality and toxicity from about ``sample`` labelled documents at most.

    The sample is taken by a hash of doc_id, so it does not depend on the layout.
    """
    known = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(F.min("quality").cast("long").alias("quality"),
                  F.max("toxic").cast("long").alias("toxic"))
             .where("quality is not null and toxic is not null"))
    n = known.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 62)) < int(min(1.0, sample / max(1, n)) * (1 << 62))
    chosen = materialize(known.where(part), "quality-sample")     # ``sample`` rows, about: broadcast
    got = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
           .select("text", "quality", "toxic")
           .mapInArrow(_feature_stage, "quality long, toxic long, buckets array<int>,"
                                       " shape array<double>").toPandas())
    lens = [len(b) for b in got["buckets"]]
    doc = np.repeat(np.arange(len(got)), lens)
    bucket = np.concatenate([np.asarray(b, np.int64) for b in got["buckets"]]) if len(got) \
        else np.empty(0, np.int64)
    shape = np.array([np.asarray(s) for s in got["shape"]]).reshape(len(got), N_SHAPE)
    worded = np.array(lens, int) > 0
    quality = got["quality"].to_numpy(np.int64)
    toxic = got["toxic"].to_numpy(np.int64)
    number = np.cumsum(worded) - 1
    doc, shape = number[doc], shape[worded]
    good = fit(doc, bucket, shape, quality[worded])
    bad = toxic[worded]
    if len(bad) and bad.max() == 0 or not len(bad):
        return good, Head(-30.0, np.zeros(BUCKETS), np.zeros(N_SHAPE), good.mean, good.sd)
    return good, fit(doc, bucket, shape, bad)


def _score_stage(heads, extra: tuple[str, str], row: str | None = None):
    """Arrow stage: any columns with ``text`` (or a struct ``row`` that has it) -> the same and both
    probabilities."""

    def run(batches):
        good, bad = heads()
        wanted = (good.buckets != 0) | (bad.buckets != 0)      # others weigh nothing
        for b in batches:
            out = [np.empty(b.num_rows), np.empty(b.num_rows)]
            text = b.column("text") if row is None else pc.struct_field(b.column(row), "text")
            for w, doc, bucket, shape in features(text, wanted):
                rows = slice(w.first_doc, w.first_doc + w.n_docs)
                for k, head in enumerate((good, bad)):
                    z = np.clip(head.log_odds(w.n_docs, doc, bucket, shape), -30, 30)
                    out[k][rows] = np.where(w.counts > 0, 1 / (1 + np.exp(-z)), 0.0)
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, out)],
                                             names=[*b.schema.names, *extra])

    return tb.trimmed(run)


def with_probabilities(df: DataFrame, heads: tuple[Head, Head],
                       names: tuple[str, str] = ("quality_prob", "toxic_prob"), row: str | None = None) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(heads)     # fixed size: two weight vectors
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    return df.mapInArrow(_score_stage(lambda: shared.value, names, row), schema)


def posteriors(scored: DataFrame, host: str, path: list[str]) -> DataFrame:
    """Shrunk means of every path: the path columns, n, good, strength, host_mean, base.

    ``scored`` has the columns and ``p``.  Strengths come from the spread of the site
    means beyond sampling noise (moments of a beta-binomial).
    """
    keys = list(dict.fromkeys([host, *path]))
    paths = materialize(scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("good"),
                                                  F.sum(F.col("p") * (1 - F.col("p"))).alias("noise")),
                        "quality-paths")
    hosts = paths.groupBy(F.col(host).alias("_host")).agg(
        F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    base = min(1 - EPS, max(EPS, (total["good"] or 0.0) / max(1, total["n"] or 0)))

    def strength(sites: DataFrame, n: str, mean: str, centre) -> float:
        """Moments: spread = base (1 - base) / (strength + 1), after the noise of n draws."""
        w = F.col(n)
        got = sites.agg(F.sum(w * (F.col(mean) - centre) ** 2).alias("spread"), F.sum(w).alias("w"),
                        F.count(F.lit(1)).alias("sites")).first()
        if not got["w"]:
            return 10.0
        noise = base * (1 - base) * got["sites"] / got["w"]
        spread = max(got["spread"] / got["w"] - noise, 1e-5)
        return float(min(1e4, max(2.0, base * (1 - base) / spread - 1)))

    s0 = strength(hosts.withColumn("m", F.col("host_good") / F.col("host_n")), "host_n", "m", F.lit(base))
    hosts = hosts.withColumn("host_mean", (F.lit(s0 * base) + F.col("host_good")) / (F.lit(s0) + F.col("host_n")))
    both = paths.join(hosts, paths[host].eqNullSafe(hosts["_host"])).withColumn("m", F.col("good") / F.col("n"))
    s1 = strength(both, "n", "m", F.col("host_mean"))
    return materialize(both.select(*keys, "n", "good", F.lit(s1).alias("strength"), "host_mean",
                                   F.lit(base).alias("base")), "quality-sites")


def _logit(p):
    p = F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS))
    return F.log(p / (1 - p))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source",
             path: tuple[str, ...] = ("source", "lang"), keep_from: float = 0.5,
             sample: int = 6000, carry: bool = False) -> DataFrame:
    """Per row: doc_id, quality_prob, toxic_prob, site, score, kept (or, with ``carry``,
    the row itself as ``_row`` and these)."""
    heads = train(docs, labels, sample)
    keys = list(dict.fromkeys([host, *path]))
    p = (F.col("quality_prob") * (1 - F.col("toxic_prob"))).alias("p")
    names = [f"k{i}" for i in range(len(keys))]
    # a text travels to the workers once, in its row or by itself
    what = [F.struct(*[docs[c] for c in docs.columns]).alias("_row")] if carry else [docs["doc_id"], docs["text"]]
    keyed = [docs[k].alias(n) for n, k in zip(names, keys)]
    scored = with_probabilities(docs.select(*keyed, *what), heads, row="_row" if carry else None).select(
        "_row" if carry else "doc_id", *names, "quality_prob", "toxic_prob", p)
    if carry:      # texts are scored for the sites and again beside them: whole rows are not written
        for_sites = with_probabilities(docs.select(*keyed, docs["text"]), heads).select(*names, p)
    else:          # every text is scored once, the narrow scores are written and read again
        scored = materialize(scored, "quality-scores")
        for_sites = scored.select(*names, "p")
    sites = posteriors(for_sites, "k0", names[1:])
    cond = None
    for k in names:
        c = scored[k].eqNullSafe(sites[k])
        cond = c if cond is None else cond & c
    s = F.col("strength")
    # the path without the document itself
    site = (s * F.col("host_mean") + F.greatest(F.col("good") - F.col("p"), F.lit(0.0))) / (
        s + F.col("n") - 1)
    out = scored.join(sites.select(*names, "n", "good", "strength", "host_mean", "base"), cond)
    log_odds = _logit(F.col("p")) + _logit(site) - _logit(F.col("base"))
    out = out.withColumn("site", site).withColumn(
        "score", F.when(F.col("quality_prob") == 0, F.lit(0.0)).otherwise(1 / (1 + F.exp(-log_odds))))
    lead = ["_row"] if carry else ["doc_id"]
    return out.select(*lead, "quality_prob", "toxic_prob", "site", "score",
                      (F.col("score") >= keep_from).alias("kept"))


def filter_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps."""
    return classify(docs, labels, carry=True, **options).where("kept").select("_row.*")
