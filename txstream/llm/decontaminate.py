"""Benchmark decontamination by winnowing.

Words are the lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  An
item's windows are its runs of ``window`` (10) consecutive words; a shorter item with
words is one window.  Every window has a fingerprint, the minimum hash of its k-grams
(k = 5): windows that overlap mostly share it, so a text has few, and equal windows have
equal ones, so joining the fingerprints of both sides by value misses no window.  Items
shorter than a window are fingerprinted whole, with k their length.

A joined fingerprint is extended to the windows around it: those document windows that
carry it, compared with the items' windows by 128-bit hashes.  Distinct windows of the
items are kept once, with the set of items that have them, and equal sets once; so a passage
that many documents and many items share makes a row a document and window, not one a
document and item, and repeated words make as many rows as there are words.

A Bloom filter over the items' fingerprints thins out the documents' before the join;
the joins themselves are exact.

Defined results: null and empty texts have no words, no hits and stay; an item that
occurs several times in the benchmark (equal item_id) counts once; a null item_id
marks words but is in no list of ids; repeated documents each get their row; an empty
benchmark hits nothing; further columns are ignored, and those of ``drop_contaminated``
pass unchanged whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from txstream.llm import bloom, textbytes as tb
from txstream.session import materialize, settled

U = np.uint64
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TO_LOWER = str.maketrans({c: chr(c + 32) for c in range(0x41, 0x5B)})
FACTORS = U(0xD1342543DE82EF95), U(0x9FB21C651E98DF25)
SMALL = 500_000      # rejected documents that are broadcast; more are joined by a shuffle


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(TO_LOWER))


def minima(words: tb.Words, hashes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and fingerprint of every run of ``window`` words inside one document."""
    g, at = words.grams(hashes, k)
    stretch = window - k + 1
    n = len(g) - stretch + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U)
    low = g[:n].copy()
    for j in range(1, stretch):
        np.minimum(low, g[j:j + n], out=low)
    doc_end = words.bounds[1:][np.searchsorted(words.bounds, at[:n], side="right") - 1]
    whole = np.flatnonzero(at[:n] + window <= doc_end)
    return at[whole], low[whole]


def _salted(g: np.ndarray, k: int) -> np.ndarray:
    return tb.mix(g + U(k))


def window_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the runs of ``size`` words at ``first``."""
    out = []
    for n, factor in enumerate(FACTORS):
        h = np.zeros(len(first), U)
        for j in range(size):
            word = hashes[first + j]
            h = h * factor + (tb.mix(word + factor) if n else word)
        out.append(tb.mix(h + U(size)))
    return out[0], out[1]


def _passing(known: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Places whose fingerprint may be an item's; neighbours of equal ones are asked once."""
    if not len(fp):
        return np.empty(0, np.int64)
    head = np.concatenate(([0], np.flatnonzero(fp[1:] != fp[:-1]) + 1))
    return np.flatnonzero(np.repeat(bloom.contains(known, fp[head]), np.diff(np.append(head, len(fp)))))


def _item_stage(k: int, window: int):
    """Arrow stage: items -> their windows: fp, wa, wb, size, item."""

    def run(batches):
        for b in batches:
            item = np.asarray(b.column("item"))
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                h, doc = w.hashes(), w.docs()
                parts = []
                first, fp = minima(w, h, k, window)
                parts.append((first, _salted(fp, 0), window))
                for n in range(1, window):
                    g, at = w.grams(h, n)
                    only = w.counts[doc[at]] == n
                    parts.append((at[only], _salted(g[only], n), n))
                for first, fp, n in parts:
                    wa, wb = window_hashes(h, first, n)
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(x.view(np.int64)) for x in (fp, wa, wb)),
                         pa.array(np.full(len(first), n)), pa.array(item[w.first_doc + doc[first]])],
                        names=["fp", "wa", "wb", "size", "item"])

    return run


def _document_stage(k: int, window: int, short: list[int], filter_words):
    """Arrow stage: documents -> n_words and the windows whose fingerprint may be an item's."""

    def run(batches):
        known = filter_words()
        for b in batches:
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                h = w.hashes()
                first, fp = minima(w, h, k, window)
                parts = [(first, _salted(fp, 0), window)]
                for n in short:
                    g, at = w.grams(h, n)
                    parts.append((at, _salted(g, n), n))
                cols = [[], [], [], [], []]
                for first, fp, n in parts:
                    use = _passing(known, fp)
                    first = first[use]
                    wa, wb = window_hashes(h, first, n)
                    for c, x in zip(cols, (first, fp[use], wa, wb, np.full(len(first), n))):
                        c.append(x)
                first, fp, wa, wb, size = map(np.concatenate, cols)
                doc = w.docs()[first]
                order = np.argsort(doc, kind="stable")
                cut = pa.array(np.searchsorted(doc[order], np.arange(w.n_docs + 1)).astype(np.int32))
                rows = slice(w.first_doc, w.first_doc + w.n_docs)
                lists = [pa.ListArray.from_arrays(cut, pa.array(x[order].view(np.int64)))
                         for x in (first - w.bounds[doc], fp, wa, wb, size)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[rows], b.column("text_hash")[rows], pa.array(w.counts), *lists],
                    names=["doc_id", "text_hash", "n_words", "first", "fp", "wa", "wb", "size"])

    return tb.trimmed(run)


def item_windows(benchmark: DataFrame, window: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (fp, wa, wb, size, set) and the sets of item_ids (set, ids) that have them."""
    items = materialize(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
                        .where("text is not null")
                        .groupBy("text").agg(F.collect_set("item_id").alias("ids"))
                        .select(F.monotonically_increasing_id().alias("item"), "text", "ids"), "items")
    found = items.select("item", "text").mapInArrow(
        _item_stage(k, window), "fp long, wa long, wb long, size long, item long")
    shared = (found.groupBy("wa", "wb", "size").agg(F.first("fp").alias("fp"),
                                                    F.array_sort(F.collect_set("item")).alias("of")))
    shared = materialize(shared.withColumn("set", F.sha2(F.array_join(F.transform(
        "of", lambda x: x.cast("string")), ","), 256)), "item-windows")
    sets = shared.groupBy("set").agg(F.first("of").alias("of"))
    ids = (sets.select("set", F.explode("of").alias("item")).join(items.select("item", "ids"), "item")
           .groupBy("set").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids")))
    return shared.drop("of"), materialize(ids, "item-sets")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, items (distinct item_ids as strings)."""
    spark = docs.sparkSession
    windows, sets = item_windows(benchmark, window, k)
    short = [r["size"] for r in windows.where(F.col("size") < window).select("size").distinct().collect()]
    known = spark.sparkContext.broadcast(bloom.build(windows, "fp"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = materialize(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
            _document_stage(k, window, sorted(short), lambda: known.value),
            f"doc_id {kind}, text_hash long, n_words long, first array<long>, fp array<long>,"
            " wa array<long>, wb array<long>, size array<long>")
        .withColumn("uid", F.monotonically_increasing_id()), "doc-windows")
    prints = windows.select("fp").distinct()
    hits = (rows.where(F.size("first") > 0)
            .select("uid", F.explode(F.arrays_zip("first", "fp", "wa", "wb", "size")).alias("z"))
            .select("uid", "z.*").join(prints, "fp", "left_semi")
            .join(windows.select("wa", "wb", "size", "set"), ["wa", "wb", "size"])
            .select("uid", "first", "size", "set"))
    hits = materialize(hits, "doc-hits")
    # words covered by the windows: what each adds behind the farthest end so far
    before = Window.partitionBy("uid").orderBy("first", "size").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("first") + F.col("size")
    covered = hits.select("uid", F.greatest(F.lit(0), end - F.greatest(
        F.col("first"), F.coalesce(F.max(end).over(before), F.lit(0)))).alias("more"))
    counts = covered.groupBy("uid").agg(F.sum("more").alias("n_hit"))
    named = (hits.select("uid", "set").distinct().join(sets, "set").groupBy("uid")
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items")))
    none = F.array().cast("array<string>")
    return (rows.select("uid", "doc_id", "text_hash", "n_words").join(counts.join(named, "uid", "left"), "uid", "left")
            .select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", none).alias("items")))


def report(found: DataFrame) -> DataFrame:
    """The per-document digest of ``contamination``."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text's xxhash64 are not in ``gone`` (doc_id, text_hash).

    Up to SMALL rejected documents are counted and broadcast, so that no text is shuffled; more of
    them are joined by a shuffle.  Columns of any name pass.
    """
    gone = materialize(gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th")).distinct(), "gone")
    if gone.count() <= SMALL:
        gone = F.broadcast(gone)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    return rows.join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_id"))
                     & (F.xxhash64("_row.text") == F.col("_th")), "left_anti").select("_row.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any hit word."""
    hit = settled(docs.sparkSession, lambda: contamination(docs, benchmark, **options).where("n_hit > 0").select(
        "doc_id", "text_hash"), "contaminated")
    return without(docs, hit)
