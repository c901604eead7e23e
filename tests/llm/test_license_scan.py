import numpy as np

from txstream.llm import license_scan as ls
from txstream.llm.decontaminate import words_of


def shortest(part, t):
    """The first of the shortest stretches with the words that t needs, over all stretches."""
    for size in range(t.need, len(part) + 1):
        for i in range(len(part) - size + 1):
            if len(set(part[i:i + size]) & set(t.words)) >= t.need:
                return i, i + size
    return None


def beside(part, t, longer):
    """t is in the block also where the longer notices' places are blotted out."""
    rest = list(part)
    for u in longer:
        while (x := shortest(rest, u)) is not None:
            rest[x[0]:x[1]] = [None] * (x[1] - x[0])
    return shortest(rest, t) is not None


def brute(text, marks, block):
    """All phrases at all places, and every template against every block."""
    w, half = words_of(text), block // 2
    places = [(i, t.label) for t in marks if t.phrase for i in range(len(w))
              if tuple(w[i:i + len(t.words)]) == t.words]
    base, labels, best = {x for _, x in places}, set(), 0.0
    for b in range(0, max(1, len(w)), half):
        part = set(w[b:b + block])
        found = [t for t in marks if not t.phrase and len(part & set(t.words)) >= t.need]
        for t in found:
            longer = [u for u in found if set(t.words) < set(u.words)]
            if not longer or beside(w[b:b + block], t, longer):
                labels.add(t.label)
        best = max([best, *(len(part & set(t.words)) / len(t.words) for t in found)])
    starts = sorted(i for i, _ in places)
    return (len(w), len(starts), starts[0] if starts else None, starts[-1] if starts else None,
            ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best)


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = sorted({w for t in ls.templates() for w in t.words}) + ["zu", "und", "é", "2"]
    texts = [None, "", "...", "MIT License", "mit\nlicense, MIT-License x mit mit license",
             "the General  Public License general public", "license mit", "mit " * 500 + "license",
             "x " * 5000 + ls.NOTICES[3][1] + " y" * 300, "Licensed under CC BY-NC 4.0.",
             "apache license general public license mit license"]
    for _, notice in ls.NOTICES:
        w = words_of(notice)
        for drop in (0, 1, 3, 5):
            keep = [x for i, x in enumerate(w) if i >= drop]
            rng.shuffle(keep)
            texts.append("a b " * int(rng.integers(0, 120)) + " q ".join(keep))
    texts += [" ".join(rng.choice(vocab, int(rng.integers(1, 400)))) for _ in range(60)]
    by, nc, sa = (f"licensed under cc by{x} 4 0 " for x in ("", " nc", " sa"))
    texts += ["u " * int(rng.integers(0, 90)) + "".join(rng.choice([by, nc, sa, "x y ", "cc by ", "4 0 "], 6))
              for _ in range(40)]
    texts += texts[:5]
    rows = [(i if i % 11 else None, t, "l") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = [tuple(r) for r in ls.scan_licenses(df.repartition(3)).collect()]
    marks = ls.templates()
    block = 4 * max(len(t.words) for t in marks)
    want = [(r[0], *brute(r[1], marks, block)) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert ls.scan_licenses(df.limit(0)).count() == 0


def test_notices_that_are_both_there(spark):
    by, nc, sa = "Licensed under CC BY 4.0. ", "Licensed under CC BY-NC 4.0. ", "Licensed under CC BY-SA 4.0. "
    cases = [(by, "cc-by"), (nc, "cc-by-nc"), (by + nc, "cc-by,cc-by-nc"), (nc + "the text is " + by, "cc-by,cc-by-nc"),
             (nc + "or " + sa, "cc-by-nc,cc-by-sa"), (nc + nc, "cc-by-nc"), (sa + by + nc, "cc-by,cc-by-nc,cc-by-sa"),
             ("x " * 300 + by + "y " * 40 + sa + "z " * 300, "cc-by,cc-by-sa"), ("under CC BY-NC 4.0", "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in ls.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]
