"""Quality rules with risk-controlled thresholds.

Base rules are fixed.  For the statistics in ``STATISTICS`` the cutoffs are selected
together per stratum (language).  A text is one trial however many documents are copies of it:
equal texts of a stratum count once, good if most of their labels are.  All labelled bad texts and a
quarter of the good ones (by a hash of the text) give a chain of rule sets, each stricter than the one before:
the next cutoff is the one that rejects most further bad documents for the further good
ones, while the set rejects at most ``risk`` of that quarter.  The other good documents
test the sets in this order.  A set holds while its false rejections k of n by any of its
rules together have an exact binomial (Clopper-Pearson) upper bound of at most ``risk``,
that is P(Bin(n, risk) <= k) <= delta / strata; the last set before the first failure is
taken.  The chain does not depend on the documents that test it and the test ends at the
first failure, so with probability 1 - ``delta`` no stratum loses more than ``risk`` of
its good texts that pass the base rules to all statistics together.  A cutoff that
rejects no further bad document is not set; the statistic is then off there.

Defined results: null and empty texts have no words and fail the base rules; a null
language is a stratum of its own; labels that repeat count once, as the worse one;
labels with nulls are left out; without labels only the base rules hold; repeated
rows are judged alike; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txstream.llm import textbytes as tb
from txstream.session import materialize

U = np.uint64
WHITE = " \t\n\v\f\r"
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)

# Statistics (larger is worse) and their cutoffs, loosest first.
STATISTICS = {
    "symbols_per_word": [2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05, 0.02],
    "repeat_share": [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1],
    "dup_lines_per_100_words": [20.0, 10.0, 5.0, 3.0, 2.0, 1.0],
    "word_length": [30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0],
    "capital_share": [0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1],
}


def repeated_words(words: tb.Words, hashes: np.ndarray, k: int = 3) -> np.ndarray:
    """Per document, words inside k-word windows that occur twice or more in it."""
    g, at = words.grams(hashes, k)
    doc = words.docs()
    hit = np.zeros(len(hashes), bool)
    if len(g):
        key = tb.mix(g + doc[at].astype(U) * U(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        s, d = key[order], doc[at][order]
        twin = np.zeros(len(s), bool)
        same = (s[1:] == s[:-1]) & (d[1:] == d[:-1])
        twin[1:] |= same
        twin[:-1] |= same
        first = at[order[twin]]
        for j in range(k):
            hit[first + j] = True
    return np.bincount(doc[hit], minlength=words.n_docs)


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def _measure_stage(batches):
    for b in batches:
        raw, offsets = tb.buffers(b.column("text"))
        texts = b.column("text").to_pylist()
        for w in tb.scan(b.column("text"), tb.BLANK_SPLIT, False):
            part = w.data
            inside = tb.BLANK_SPLIT[part] & ((part & 0xC0) != 0x80)
            sums = lambda f: np.diff(np.concatenate(([0], np.cumsum(f)))[w.offsets])
            upper = (part >= 0x41) & (part <= 0x5A)
            letter = upper | ((part >= 0x61) & (part <= 0x7A))
            rows = slice(w.first_doc, w.first_doc + w.n_docs)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")[rows], b.column("lang")[rows], b.column("text_hash")[rows], pa.array(w.counts),
                 pa.array(sums(inside)), pa.array(sums(np.isin(part, SYMBOLS))),
                 pa.array([duplicate_lines(t) for t in texts[rows]], pa.int64()),
                 pa.array(repeated_words(w, w.hashes())), pa.array(sums(upper)),
                 pa.array(sums(letter))],
                names=["doc_id", "lang", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "n_upper", "n_letters"])


def measure(docs: DataFrame) -> DataFrame:
    """Counts of every whole text."""
    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text",
                       F.xxhash64("text").alias("text_hash")).mapInArrow(
        _measure_stage, "doc_id long, lang string, text_hash long, n_words long, word_chars long, n_symbols long,"
                        " n_dup_lines long, n_repeat_words long, n_upper long, n_letters long")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def statistics() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols_per_word": F.col("n_symbols") / n,
        "repeat_share": F.col("n_repeat_words") / n,
        "dup_lines_per_100_words": 100 * F.col("n_dup_lines") / n,
        "word_length": F.col("word_chars") / n,
        "capital_share": F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed exactly from the largest term down."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, -1, -1)]
    top = max(logs)
    if top < -745:
        return 0.0
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def admissible(k: int, n: int, risk: float, level: float) -> bool:
    """The exact upper bound at ``level`` of k rejections of n is at most ``risk``."""
    if n == 0 or k / n > risk:
        return False
    return binomial_tail(k, n, risk) <= level


def rule_chain(places: np.ndarray, good: np.ndarray, bad: np.ndarray, risk: float) -> list[np.ndarray]:
    """Rule sets, looser first.  Rule r of a statistic rejects places >= r; every row of
    ``places`` (cutoffs exceeded per statistic) stands for ``good`` and ``bad`` documents."""
    rules = np.array([len(c) + 1 for c in STATISTICS.values()])      # all off
    gone, budget, chain = np.zeros(len(places), bool), risk * good.sum(), []
    while True:
        best, at = 0.0, None
        for s in range(len(rules)):
            for r in range(rules[s] - 1, 0, -1):
                new = ~gone & (places[:, s] >= r)
                cost, gain = good[new].sum(), bad[new].sum()
                if good[gone].sum() + cost > budget:
                    break
                if gain / (1 + cost) > best:
                    best, at = gain / (1 + cost), (s, r)
        if at is None:
            return chain
        s, last = at
        for r in range(rules[s] - 1, last - 1, -1):
            new = ~gone & (places[:, s] >= r)
            if bad[new].sum():
                gone |= new
                rules = rules.copy()
                rules[s] = r
                chain.append(rules)


def _select(risk: float, level: float):
    """Grouped stage: counts of one stratum by places -> the cutoff of every statistic."""

    def run(pdf):
        places, n = pdf[list(STATISTICS)].to_numpy(), pdf["n"].to_numpy()
        good, testing = pdf["good"].to_numpy(bool), pdf["testing"].to_numpy(bool)
        held, chosen = np.where(good & testing, n, 0), None
        for rules in rule_chain(places, np.where(good & ~testing, n, 0), np.where(good, 0, n), risk):
            rejected = held[(places >= rules).any(1)].sum()
            if not admissible(int(rejected), int(held.sum()), risk, level):
                break
            chosen = rules
        cutoffs = [np.inf if chosen is None or r > len(c) else c[r - 1] for c, r in zip(
            STATISTICS.values(), chosen if chosen is not None else [0] * len(STATISTICS), strict=True)]
        return pd.DataFrame({"stratum": pdf["stratum"].iloc[0], "statistic": list(STATISTICS),
                             "cutoff": cutoffs})

    return run


def thresholds(measured: DataFrame, labels: DataFrame, risk: float = 0.01,
               delta: float = 0.05) -> DataFrame:
    """stratum, statistic, cutoff (infinite: off).  One row per stratum and statistic.

    Labelled documents are counted per stratum and cutoffs exceeded before any shuffle,
    so what is gathered is bounded by the grid's cells (some 36,000) a stratum.
    """
    known = (labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .where("doc_id is not null and quality is not null"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters")
    holdout = (measured.where(~base_failed()).join(known, "doc_id").groupBy("lang", "text_hash")
               .agg(*[F.first(c).alias(c) for c in counts],        # equal texts have equal counts
                    F.avg((F.col("quality") >= 1).cast("int")).alias("share")))
    places = [sum(((stat > c).cast("int") for c in STATISTICS[name]), F.lit(0)).alias(name)
              for name, stat in statistics().items()]
    testing = F.pmod(F.xxhash64("text_hash", F.lit(5)), F.lit(4)) > 0
    cells = (holdout.select(F.col("lang").alias("stratum"), *places, testing.alias("testing"),
                            (F.col("share") >= 0.5).alias("good"))
             .groupBy("stratum", *STATISTICS, "testing", "good").agg(F.count(F.lit(1)).alias("n")))
    cells = materialize(cells, "rule-cells")
    strata = cells.select("stratum").distinct().count()
    return cells.groupBy("stratum").applyInPandas(
        _select(risk, delta / max(1, strata)), "stratum string, statistic string, cutoff double")


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, and the rules it broke."""
    measured = materialize(measure(docs), "rule-counts")
    cut = (thresholds(measured, labels, risk, delta).groupBy("stratum")
           .pivot("statistic", list(STATISTICS)).agg(F.first("cutoff")))
    cut = materialize(cut, "rule-cutoffs")
    joined = measured.join(cut, measured["lang"].eqNullSafe(cut["stratum"]), "left")
    broken = F.filter(F.array(*[F.when(stat > F.col(f"`{name}`"), F.lit(name))
                                for name, stat in statistics().items()]), lambda x: x.isNotNull())
    failed = base_failed()
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.size(broken) == 0)).alias("kept"),
        F.array_join(broken, ",").alias("broken"))
