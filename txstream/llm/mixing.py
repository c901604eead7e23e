"""Mixing sources to target weights with Efraimidis-Spirakis sampling, DataFrame functions only.

Each source's target is a share of ``share`` (1.5) times all words by the sources'
weights, at most ``most`` (2) times its size, what is cut off going to the others by
weight.  A document is taken ``floor(target / source size)`` whole times (complete
epochs); for the rest every document gets the exponential key ``-ln(u) / quality``,
u being a hash of its doc_id and quality a column of weights (a classifier's score) or, without
one, the text's share of letters, and the documents of smallest key are taken until the
remaining words are filled, the last one if that comes nearer the target.

No source is ever ordered in one task: keys are counted in about sqrt(n) buckets per
source, prefix sums over buckets find the one where the budget ends, and only that
bucket's keys are ordered.  The result is a threshold per source, so every document
decides for itself and texts are never shuffled.

Defined results: null and empty texts have size 0 and quality 1; a null source is a
source of its own and comes last; rows of equal key (repeated rows) are taken or left
together unless their order (doc_id, then size) differs; a null doc_id is replaced by the
text's hash for the key; a source of size 0 has target 0 and is taken once as it is; an
empty table gives no row; columns of clashing names survive in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txstream.session import materialize, settled

# The weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    blank = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(blank, r"[\x20\x09-\x0D]+", "")).cast("long")


def quality_of(text: Column) -> Column:
    """Share of letters and white space among the characters, 0.05 at least."""
    n = F.length(text)
    signs = F.length(F.regexp_replace(text, r"[\p{L}\x20\x09-\x0D]+", ""))
    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.05), F.lit(1.0) - signs / n))


def key_of(doc_id: Column, text: Column, quality: Column, seed: str) -> Column:
    """Exponential key: 52 bits of a hash as u, then -ln(u) / quality."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13), 16, 10).cast("long")
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / quality


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, docs -> target too.  One row a source, so plain windows do.

    Capping and resharing end at ``min(cap, level * weight)`` for one level: the
    smallest number of capped sources (in the order of cap / weight) whose level is
    below the next source's cap / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) * F.lit(share)
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    tried = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    # levels only fit from the first source on that need not be capped
    best = tried.withColumn("level", F.min_by(fits, F.when(fits.isNotNull(), F.col("cap") / F.col("weight")))
                            .over(whole))
    return best.select("source", "source_size", "docs", F.coalesce(
        F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def _weight(text: Column, column: Column | None) -> Column:
    """The quality weight: a column's values (0.05 at least, null: 1), or ``quality_of`` the text."""
    if column is None:
        return quality_of(text)
    return F.coalesce(F.greatest(F.lit(0.05), column.cast("double")), F.lit(1.0))


def _measured(docs: DataFrame, seed: str, quality: str | None = None) -> DataFrame:
    text = F.col("text")
    weight = _weight(text, F.col(quality) if quality else None)
    return docs.select("doc_id", "source", size_of(text).alias("size"),
                       key_of(F.col("doc_id"), text, weight, seed).alias("key"))


def thresholds(measured: DataFrame, **options) -> DataFrame:
    """Per source: target, whole epochs, and the last (key, doc_id, size) of the fraction."""
    sizes = measured.groupBy("source").agg(F.sum("size").alias("source_size"),
                                           F.count(F.lit(1)).alias("docs"))
    plan = targets(sizes, **options)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    plan = materialize(plan.withColumn("epochs", epochs.cast("long")).withColumn(
        "budget", F.when(F.col("source_size") > 0,
                         F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0))
        .withColumn("buckets", F.ceil(F.sqrt("docs"))), "mix-plan")

    p = plan.select(F.col("source").alias("_s"), "budget", "buckets")
    # keys are about exponential: 1 - exp(-key) spreads them evenly, and keeps their order
    placed = measured.join(p, measured["source"].eqNullSafe(F.col("_s"))).select(
        "source", "doc_id", "size", "key", "budget",
        F.floor((1 - F.exp(-F.col("key"))) * F.col("buckets")).alias("bucket"))
    counted = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"),
                                                     F.first("budget").alias("budget"))
    running = Window.partitionBy("source").orderBy("bucket")
    open_at = (counted.withColumn("upto", F.sum("words").over(running))
               .where((F.col("upto") - F.col("words") < F.col("budget"))
                      & (F.col("upto") >= F.col("budget")) & (F.col("words") > 0))
               .select(F.col("source").alias("_s"), F.col("bucket").alias("_b"),
                       (F.col("upto") - F.col("words")).alias("base")))
    inside = placed.join(open_at, placed["source"].eqNullSafe(F.col("_s"))
                         & (placed["bucket"] == F.col("_b")))
    order = (Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size"))
    filled = (inside.withColumn("upto", F.col("base") + F.sum("size").over(
        order.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("group", F.sum("size").over(Window.partitionBy("source", "key", "doc_id", "size"))))
    # a document is in if its end is not farther from the budget than its beginning
    taken = filled.where(2 * F.col("upto") - F.col("group") <= 2 * F.col("budget"))
    last = taken.groupBy("source").agg(F.max(F.struct(
        "key", F.col("doc_id").isNull().alias("no_id"), "doc_id", "size")).alias("last"))
    end = open_at.select(F.col("_s").alias("source"), "_b")
    out = plan.join(end.withColumnRenamed("source", "_e"), plan["source"].eqNullSafe(F.col("_e")), "left")
    out = out.join(last.withColumnRenamed("source", "_l"), out["source"].eqNullSafe(F.col("_l")), "left")
    return materialize(out.select(
        F.col("source").alias("_source"), "source_size", "target", "epochs", F.col("budget"),
        "buckets", F.col("_b").alias("open_bucket"), "last"), "mix-thresholds")


def _copies() -> Column:
    """How often a measured row with its source's thresholds is taken."""
    bucket = F.floor((1 - F.exp(-F.col("key"))) * F.col("buckets"))
    mine = F.struct("key", F.col("doc_id").isNull().alias("no_id"), "doc_id", "size")
    within = (bucket < F.col("open_bucket")) | ((bucket == F.col("open_bucket"))
                                                & (mine <= F.col("last")))
    part = (F.col("budget") > 0) & F.coalesce(within, F.lit(False))
    return F.col("epochs") + part.cast("long")


def mixture(docs: DataFrame, seed: str = "mix", quality: str | None = None, **options) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken.

    ``quality`` names a column of quality weights, such as a classifier's score.
    """
    measured = materialize(_measured(docs, seed, quality), "mix-sizes")
    plan = thresholds(measured, **options)
    joined = measured.join(plan, measured["source"].eqNullSafe(plan["_source"]))
    return joined.withColumn("copies", _copies()).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: str = "mix", quality: str | None = None, **options) -> DataFrame:
    """The rows of ``docs``, each repeated as often as the mixture takes it."""
    plan = settled(docs.sparkSession, lambda: thresholds(
        materialize(_measured(docs, seed, quality), "mix-sizes"), **options), "mix-thresholds")
    text = F.col("_row.text")
    weight = _weight(text, F.col("_row")[quality] if quality else None)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    measured = rows.select(
        "_row", F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"),
        size_of(text).alias("size"),
        key_of(F.col("_row.doc_id"), text, weight, seed).alias("key"))
    copies = _copies().alias("copies")
    return (measured.join(plan, F.col("source").eqNullSafe(plan["_source"]))
            .select("_row", copies).where("copies > 0")
            .select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("_row.*"))
