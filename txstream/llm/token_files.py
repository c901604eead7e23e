"""Token ids in Huffman-coded block files.

A folder holds ``codebook`` (one row: the code length of every id) and ``blocks``, a
Parquet container written by Spark's committer, so that lost executors leave no
half-written file.  Each row of ``blocks`` is one independent block: part, block,
first (ids before it in its part), n_docs, n_tokens and ``payload``:

    'TXH1', interval u32, n_docs u64, n_bytes u64, then per document: null flag u8,
    doc_id i64, n_tokens u64, n_bytes u64; then per checkpoint: bit offset in its document u32;
    then the bits, every document from a byte of its own.  All little-endian.

Parts are ranges of ascending doc_id (null first), blocks ascend inside a part.  A
block holds whole documents and ends after ``block_tokens`` ids.

Defined results: null and empty texts are documents of the end id alone; documents
of equal doc_id stand in the order of their ids' number and checksum; repeated rows
are kept; an empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from txstream.llm import huffman
from txstream.llm.pieces import FORGET, encoder
from txstream.llm.textbytes import chunks, release_memory, trimmed
from txstream.session import materialize, temporary_tables, write_parquet

MAGIC = b"TXH1"
HEAD = struct.Struct("<4sIQQ")
STEP = 200_000       # ids coded at once


def _tokenize_stage(path: str, end_id: int):
    """Arrow stage: doc_id, text -> doc_id, n_tokens, ids (u32 or u16), checksum."""

    def run(batches):
        enc = encoder(path)
        small = enc.library.get_vocab_size(with_added_tokens=True) <= 1 << 16
        kind = np.uint16 if small and end_id < 1 << 16 else np.uint32
        for b in batches:
            texts = b.column("text").fill_null("")
            size = np.concatenate(([0], np.cumsum(np.asarray(pc.utf8_length(texts), np.int64))))
            for i, j in chunks(size, 1 << 20):
                ids, bounds = enc.encode(texts[i:j].to_pylist())
                ids = np.insert(ids, bounds[1:], end_id).astype(kind)
                bounds = bounds + np.arange(len(bounds))
                raw, width = ids.tobytes(), ids.itemsize
                rows = [raw[x * width:y * width] for x, y in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[i:j], pa.array(np.diff(bounds)), pa.array(rows, pa.binary()),
                     pa.array([zlib.crc32(r) for r in rows], pa.int64())],
                    names=["doc_id", "n_tokens", "ids", "crc"])

    return trimmed(run, keep=FORGET)        # the pieces remembered by earlier tasks stay


def _unpack(b):
    """Row ranges of about STEP ids: first and last row, their ids and bounds."""
    n = np.asarray(b.column("n_tokens"), np.int64)
    bounds = np.concatenate(([0], np.cumsum(n)))
    for i, j in chunks(bounds, STEP):
        raw = b"".join(b.column("ids")[i:j].to_pylist())
        width = len(raw) // max(1, int(bounds[j] - bounds[i]))
        yield i, j, np.frombuffer(raw, np.uint16 if width == 2 else np.uint32), bounds[i:j + 1] - bounds[i]


def _count_stage(batches):
    """Arrow stage: token table -> count of every id in this task."""
    release_memory()
    total = np.zeros(0, np.int64)
    for b in batches:
        for _, _, ids, _ in _unpack(b):
            got = np.bincount(ids, minlength=len(total))
            got[:len(total)] += total
            total = got
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def _bits_stage(lengths: np.ndarray, interval: int, bounds: list[tuple]):
    """Arrow stage: token table -> every document's part, own bits and checkpoints.

    Part p holds the documents between bounds p - 1 and p; one equal to several bounds
    (a row that is repeated very often) may go to any part between them.
    """
    codes, _ = huffman.canonical_codes(lengths)

    def part(key, k):
        low = bisect.bisect_left(bounds, key)
        return low + k % (bisect.bisect_right(bounds, key, lo=low) - low + 1)

    def run(batches):
        for b in batches:
            for i, j, ids, cut in _unpack(b):
                bits, at, marks, mark_at = huffman.encode(ids, cut, lengths, codes, interval)
                raw, mraw = bits.tobytes(), marks.tobytes()
                keys = zip(*(b.column(c)[i:j].to_pylist() for c in ("doc_id", "n_tokens", "crc")))
                parts = [part(_key(*x), k) for k, x in enumerate(keys, i)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.int32()), b.column("doc_id")[i:j], b.column("n_tokens")[i:j],
                     b.column("crc")[i:j],
                     pa.array([raw[x:y] for x, y in zip(at, at[1:])], pa.binary()),
                     pa.array([mraw[4 * x:4 * y] for x, y in zip(mark_at, mark_at[1:])],
                              pa.binary())],
                    names=["p", "doc_id", "n_tokens", "crc", "bits", "marks"])

    return trimmed(run)


def _key(doc_id, n_tokens: int, crc: int) -> tuple:
    return (doc_id is not None, doc_id or 0, n_tokens, crc)


def part_bounds(tokens: DataFrame, parts: int, each: int = 60, most: int = 1_000_000) -> list[tuple]:
    """``parts`` - 1 keys that cut the token table into parts of about as many ids.

    From a sample by hash of about ``each`` documents a part and ``most`` at all, of three narrow
    columns: the ids themselves are not read.
    """
    n = tokens.count()
    share = min(1.0, min(parts * each, most) / max(1, n))
    found = tokens.where(F.pmod(F.xxhash64("doc_id", "crc", "n_tokens"), F.lit(1 << 62)) < int(share * (1 << 62)))
    rows = sorted((_key(r[0], r[1], r[2]), r[1]) for r in found.select("doc_id", "n_tokens", "crc").collect())
    total = sum(r[1] for r in rows)
    bounds, upto = [], 0
    for key, size in rows:
        upto += size
        while len(bounds) < parts - 1 and upto * parts >= total * (len(bounds) + 1):
            bounds.append(key)
    return bounds


def _payload(docs: list, interval: int) -> bytes:
    null = np.array([d[0] is None for d in docs], np.uint8)
    ids = np.array([d[0] or 0 for d in docs], np.int64)
    n = np.array([d[1] for d in docs], np.uint64)
    size = np.array([len(d[2]) for d in docs], np.uint64)
    bits = b"".join(d[2] for d in docs)
    return b"".join([HEAD.pack(MAGIC, interval, len(docs), len(bits)), null.tobytes(), ids.tobytes(),
                     n.tobytes(), size.tobytes(), *[d[3] for d in docs], bits])


def _blocks_stage(block_tokens: int, interval: int):
    """Arrow stage: sorted documents -> blocks."""

    def run(batches):
        part, block, first = TaskContext.get().partitionId(), 0, 0
        docs, n = [], 0

        def emit():
            return pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "first": first, "n_docs": len(docs),
                "n_tokens": n, "payload": _payload(docs, interval)}], schema=pa.schema([
                    ("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()),
                    ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())]))

        for b in batches:
            for d in zip(*(b.column(c).to_pylist() for c in ("doc_id", "n_tokens", "bits", "marks"))):
                docs.append(d)
                n += d[1]
                if n >= block_tokens:
                    yield emit()
                    block, first, docs, n = block + 1, first + n, [], 0
        if docs:
            yield emit()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                      block_tokens: int = 1 << 18, interval: int = huffman.INTERVAL) -> None:
    """Tokenize every text once, count all ids, and write codebook and blocks to ``folder``."""
    with temporary_tables(docs.sparkSession):      # the ids go when the blocks are written
        _write_token_files(docs, folder, tokenizer, end_id, block_tokens, interval)


def _write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, block_tokens: int,
                       interval: int) -> None:
    tokens = materialize(docs.select("doc_id", "text").mapInArrow(
        _tokenize_stage(tokenizer, end_id), "doc_id long, n_tokens long, ids binary, crc long"),
        "token-ids")
    # at most one row for each id of the vocabulary reaches the driver
    counted = (tokens.select("n_tokens", "ids").mapInArrow(_count_stage, "id long, n long")
               .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(int(counted["id"].max()) + 1 if len(counted) else 1, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    lengths = huffman.code_lengths(counts)
    docs.sparkSession.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary") \
        .coalesce(1).write.parquet(f"{folder}/codebook")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    write_parquet(
        tokens.mapInArrow(_bits_stage(lengths, interval, part_bounds(tokens, parts)),
                          "p int, doc_id long, n_tokens long, crc long, bits binary, marks binary")
        .repartitionById(parts, "p").drop("p")
        .sortWithinPartitions("doc_id", "n_tokens", "crc")
        .mapInArrow(_blocks_stage(block_tokens, interval),
                    "part int, block long, first long, n_docs long, n_tokens long, payload binary"),
        f"{folder}/blocks")


def _read_stage(lengths: np.ndarray):
    """Arrow stage: blocks with their start -> documents with start, ids and checksum."""

    def run(batches):
        table = huffman.decode_table(lengths)
        for b in batches:
            for start, payload in zip(b.column("start").to_pylist(), b.column("payload").to_pylist()):
                doc_id, null, bounds, ids = decode_block(payload, table)
                raw = ids.astype("<u4").tobytes()
                rows = [raw[4 * x:4 * y] for x, y in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id, mask=null), pa.array(start + bounds[:-1]),
                     pa.array(np.diff(bounds)), pa.array([zlib.crc32(r) for r in rows], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return trimmed(run)


def decode_block(payload: bytes, table):
    """doc_id, null flags, bounds and ids of one block."""
    magic, interval, n_docs, n_bytes = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEAD.size
    null = np.frombuffer(payload, np.uint8, n_docs, at).astype(bool)
    doc_id = np.frombuffer(payload, np.int64, n_docs, at + n_docs)
    n = np.frombuffer(payload, np.int64, n_docs, at + 9 * n_docs)
    size = np.frombuffer(payload, np.int64, n_docs, at + 17 * n_docs)
    at += 25 * n_docs
    marks = np.frombuffer(payload, np.uint32, int(((n + interval - 1) // interval).sum()), at)
    bits = np.frombuffer(payload, np.uint8, n_bytes, at + 4 * len(marks))
    ids = huffman.decode(bits, np.concatenate(([0], np.cumsum(size))), n, marks, table, interval)
    return doc_id, null, np.concatenate(([0], np.cumsum(n))), ids


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the blocks."""
    book = spark.read.parquet(f"{folder}/codebook").first()
    lengths = np.frombuffer(bytes(book["lengths"]), np.uint8)
    blocks = spark.read.schema("part int, block long, first long, n_docs long, n_tokens long,"
                               " payload binary").parquet(f"{folder}/blocks")
    # one row a part: prefix sums over the parts give every block its place
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    # one short row for each task that wrote blocks: small beside the blocks at any size
    placed = blocks.join(F.broadcast(before), "part").select(
        (F.col("before") + F.col("first")).alias("start"), "payload")
    return placed.mapInArrow(_read_stage(lengths),
                             "doc_id long, start long, n_tokens long, ids_crc32 long")
