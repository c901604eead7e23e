import math
import re
from collections import Counter

import pytest

from txstream.llm import risk_rules as rr


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if wins[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


TEXTS = [None, "", " \n\t", "a b c a b c", "x x x x", "l1\nl1\n\n \n \nl2\nl1 ", "é ß\x0b日本 #$<>|",
         "\x1c\x85 odd spaces\xa0here", "w " * 60, " ".join(f"w{i}" for i in range(60)),
         " ".join(f"w{i}" for i in range(49)), ("line one of it\n" * 40) + "end",
         " ".join(f"long{i % 97}" for i in range(20000)), "\r\n".join(["same", "same", "same "])]


def test_counts_equal_brute_force(spark):
    rows = [(i if i != 3 else None, t, "en" if i % 2 else None, 1) for i, t in enumerate(TEXTS)]
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    got = rr.judge(df.repartition(2), labels).collect()
    want = [(r[0], *brute(r[1])) for r in rows]
    assert sorted((tuple(g)[:7] for g in got), key=repr) == sorted(want, key=repr)
    assert all(g.kept == (not g.base_failed) for g in got)
    assert rr.judge(df.limit(0), labels).count() == 0


def test_binomial_tail_is_exact():
    for n, k, p in [(1, 0, .1), (10, 3, .2), (300, 2, .02), (5000, 60, .02), (40, 40, .3)]:
        want = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)) if n < 400 else None
        got = rr.binomial_tail(k, n, p)
        assert want is None or math.isclose(got, want, rel_tol=1e-9)
    assert not rr.admissible(0, 100, 0.02, 0.05) and rr.admissible(0, 149, 0.02, 0.05)


@pytest.mark.parametrize("n_good, holds", [(60, False), (1500, True)])
def test_cutoffs_need_enough_good_documents(spark, n_good, holds):
    clean = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"word{i}###" for i in range(80))
    rows = [(i, clean + f" {i}", "en") for i in range(n_good)] + \
           [(10_000 + i, junk + f" {i}", "en") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 10_000), 0) for r in rows] + [(None, 1, 0), (1, None, 0)],
                                   "doc_id long, quality long, toxic long")
    got = {r.doc_id: r.kept for r in rr.judge(df, labels).collect()}
    assert all(got[i] for i in range(n_good))
    assert any(got[10_000 + i] for i in range(30)) != holds


def test_all_rules_together_meet_the_risk(spark):
    """Three statistics reject 0.5 % of the good documents each, and others each."""
    words = [f"word{i}" for i in range(60)]
    faults = [lambda w: w + "###", str.upper, lambda w: w + "longer" * 6]
    rows = [(i, " ".join(map(faults[i % 200], words) if i % 200 < 3 else words) + f" {i}", lang)
            for lang, start in (("en", 0), (None, 4000)) for i in range(start, start + 4000)]
    rows += [(10_000 + i, " ".join(map(faults[i % 3], words)) + f" {i}", ("en", None)[i % 2])
             for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 10_000), 0) for r in rows],
                                   "doc_id long, quality long, toxic long")
    got = rr.judge(df, labels).collect()
    for part in (range(4000), range(4000, 8000)):
        assert sum(not r.kept for r in got if r.doc_id in part) <= 0.01 * 4000
    for odd in (0, 1):
        assert any(not r.kept for r in got if r.doc_id >= 10_000 and r.doc_id % 2 == odd)


def test_chain_is_nested_and_cheapest_first():
    import numpy as np

    places = np.array([[3, 0, 0, 0, 0], [1, 0, 0, 0, 0], [0, 2, 0, 0, 0], [0, 0, 0, 0, 0]])
    good, bad = np.array([0, 1, 1, 298]), np.array([5, 5, 30, 0])
    chain = rr.rule_chain(places, good, bad, 0.01)
    assert [c[:2].tolist() for c in chain] == [[9, 2], [3, 2], [1, 2]]
    assert all((a >= b).all() for a, b in zip(chain, chain[1:], strict=False))
    assert rr.rule_chain(places, good, bad * 0, 0.01) == []


def test_copies_are_one_trial(spark):
    """A hundred copies of each good text are no more evidence than the texts themselves."""
    clean = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"word{i}###" for i in range(80))
    rows = [(c * 1000 + i, clean + f" {i}", "en") for i in range(60) for c in range(100)] + \
           [(200_000 + i, junk + f" {i}", "en") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] < 200_000), 0) for r in rows],
                                   "doc_id long, quality long, toxic long")
    assert all(r.kept for r in rr.judge(df, labels).collect())      # 45 trials prove no risk of 1 %
    noisy = labels.selectExpr("doc_id", "if(doc_id < 3000, 0, quality) quality", "toxic")
    cells = rr.thresholds(rr.measure(df), noisy).collect()
    assert len(cells) == len(rr.STATISTICS) and all(c.cutoff == math.inf for c in cells)
