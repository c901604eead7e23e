import math

from pyspark.sql import functions as F

from txstream.llm import mixing

TEXTS = ["one two three", "", None, " \t\n", "a  b\x0bc", "#### $$ x", "é ü", "word " * 4000, "tie", "tie"]


def brute_targets(sizes, weights=mixing.WEIGHTS, share=1.5, most=2.0):
    """Cap and reshare the excess by weight until no source is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            out.update({s: level * w[s] for s in open_})
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def rows_of(n=400):
    rows = []
    for i in range(n):
        source = ["b", "a", None, "c", "big", "big", "big", "big", "none"][i % 9]
        text = None if source == "none" else TEXTS[(i * 7) % len(TEXTS)] if i % 5 else "w " * (i % 90)
        rows.append((None if i % 50 == 0 else i % 380, text, source, "x"))
    return rows + rows[:5]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string")


def test_targets_and_taken_words(spark):
    rows = rows_of()
    got = mixing.mixture(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, longest = {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r["size"])
        assert 0 <= r.taken <= 2 * r["size"]
    want = brute_targets(sizes)
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9)
    for s in sizes:        # repeated rows are taken together
        assert abs(taken[s] - want[s]) <= 1.01 * longest[s] + 1


def test_smallest_keys_fill_the_fraction(spark):
    docs = frame(spark, [(i, "w " * (1 + i % 7), "s" if i % 3 else "t", "") for i in range(900)])
    measured = docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("n"), mixing.key_of(
        F.col("doc_id"), F.col("text"), mixing.quality_of(F.col("text")), "mix").alias("key"))
    got = {r.doc_id: r for r in mixing.mixture(docs).collect()}
    for s in ("s", "t"):
        mine = sorted((r.key, r.doc_id, r.n) for r in measured.where(F.col("source") == s).collect())
        size = sum(n for *_, n in mine)
        target = got[mine[0][1]].target
        epochs, budget, upto = int(target // size), target % size, 0
        for _, i, n in mine:
            part = budget > 0 and 2 * (upto + n) - n <= 2 * budget
            upto += n
            assert got[i].copies == epochs + part


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = frame(spark, rows_of(90))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == mixing.mixture(docs).agg(F.sum("copies")).first()[0]


def test_empty_table(spark):
    assert mixing.mixture(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, [])).count() == 0
