import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from txstream.llm import decontaminate as dc


def brute(docs, items, window=10):
    """doc -> (n_words, n_hit, item ids) by comparing every window with every window."""
    out = []
    for _, text in docs:
        w = dc.words_of(text)
        hit, ids = set(), set()
        for item, body in items:
            v = dc.words_of(body)
            n = min(window, len(v))
            wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    if item is not None:
                        ids.add(str(item))
        out.append((len(w), len(hit), sorted(ids)))
    return out


def check(spark, docs, items):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, item string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, fp long")
    got = dc.report(dc.contamination(d.repartition(2), b)).collect()
    want = [(i, n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0)
            for (i, _), (n, h, ids) in zip(docs, brute(docs, items))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    clean = sorted((r.doc_id or 0 for r in dc.drop_contaminated(d, b).collect()))
    assert clean == sorted(w[0] or 0 for w in want if not w[5])


LONG = " ".join(f"w{i}" for i in range(40))
CASES = [(1, LONG), (2, "Zz " + " ".join(f"W{i}" for i in range(5, 15)) + ", qq"),
         (3, " ".join(f"w{i}" for i in range(9)) + " x"), (4, None), (5, ""), (6, "!!"),
         (None, LONG), (1, LONG), (7, "a b a b a b a b a b a b a b"), (8, "short item here"),
         (9, "the short item hers"), (10, "é " + LONG * 3), (11, ("f g " * 3000) + LONG)]
ITEMS = [(1, LONG), (2, " ".join(f"w{i}" for i in range(5, 30))), (3, "a b " * 8), (4, "Short Item"),
         (5, None), (6, ""), (1, LONG), (None, "f g f"), (7, LONG), (8, "here")]


def test_edge_cases(spark):
    check(spark, CASES, ITEMS)


def test_empty_tables(spark):
    check(spark, CASES[:4], [])
    check(spark, [], ITEMS)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=0, max_size=60), min_size=1, max_size=12),
       st.lists(st.lists(st.sampled_from("abc"), min_size=0, max_size=25), min_size=1, max_size=6))
def test_random_small_alphabet(spark, docs, items):
    check(spark, [(i, " ".join(x)) for i, x in enumerate(docs)],
          [(i, " ".join(x)) for i, x in enumerate(items)])


def test_repetitive_texts_take_linear_work(spark):
    """20,000 equal words against an item of 2,000: every window of both is the same."""
    docs = [(1, "same " * 20_000), (2, "same " * 9), (3, "same " * 10), (4, "ab cd " * 6000)]
    items = [(1, "same " * 2000), (2, "ab cd " * 500), (3, "cd " * 9 + "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in dc.contamination(d, b).collect()}
    assert got == {1: (20_000, 20_000, ["1"]), 2: (9, 0, []), 3: (10, 10, ["1"]), 4: (12_000, 12_000, ["2"])}


def test_a_passage_of_many_documents_and_items(spark):
    """400 documents and 300 items share a passage: rows by document and window, ids once a document."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"begin{i} of it {passage} end {i}") for i in range(400)]
    items = [(i, f"item{i} {passage} tail{i}") for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    windows, sets = dc.item_windows(b, 10, 5)
    assert windows.count() == 21 + 300 * 2 and sets.count() == 301
    got = dc.contamination(d, b).collect()
    assert len(got) == 400 and all(r.n_hit == 30 and len(r["items"]) == 300 for r in got)
    assert got[0]["items"] == sorted(str(i) for i in range(300))


NAMES = ["_id", "_h", "_th", "_row", "k0", "uid", "fp", "_key", "_hash", "p", "text_hash", "first", "size", "_rows"]


def test_columns_of_any_name_pass(spark, monkeypatch):
    from txstream.llm import chosen_path, mixing, quality
    base = spark.createDataFrame(CASES, "doc_id long, text string").select(
        "*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in NAMES],
        F.lit("s").alias("source"), F.lit("en").alias("lang"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    for small in (dc.SMALL, 0):           # broadcast and shuffle
        monkeypatch.setattr(dc, "SMALL", small)
        for got in (dc.drop_contaminated(base, items), chosen_path.keep_one_of_each(base), mixing.mix(base),
                    quality.filter_quality(base, labels)):
            assert got.columns == base.columns
            for r in got.collect():
                assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for n in NAMES)


def test_quality_weights_from_a_column(spark):
    """Documents of higher weight are taken first for the part beyond whole epochs."""
    from txstream.llm import mixing
    docs = spark.range(4000).selectExpr("id doc_id", "'ten words of a text that is always the same one' text",
                                        "if(id % 2 = 0, 's', 't') source", "if(id % 4 < 2, 1.0D, 0.1D) good")
    got = mixing.mixture(docs, quality="good", share=0.5).join(docs.select("doc_id", "good"), "doc_id")
    taken = {r.good: r.n for r in got.groupBy("good").agg(F.avg("copies").alias("n")).collect()}
    assert taken[1.0] > 2 * taken[0.1] > 0
