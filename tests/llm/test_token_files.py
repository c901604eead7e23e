import json
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from txstream.llm import huffman, textbytes, token_files
from txstream.llm.pieces import PieceEncoder
from txstream.llm.queries import END_ID, tokenizer_path
from txstream.session import scratch_path

TEXTS = ["", " ", "  a", "a  b\n\n c", "don't we'll I'vex 's ''s x's's", "a\n'sx", " x   y",
         "<|endoftext|> hi", "日本語 テスト 12,3", "😀 a", "\t\t x\n", None, "word " * 30_000,
         "same text", "same text", "a"]


def test_pieces_equal_the_library():
    enc = PieceEncoder(tokenizer_path())
    rng = np.random.default_rng(0)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(list(" '  \n\tslltrevemda1é!."), 12))
                                        for _ in range(500)]
    for _ in range(2):      # the second time from memory
        ids, bounds = enc.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == enc.plain(texts)


def _peak_mb(work) -> float:
    tracemalloc.start()      # sees Python's and numpy's memory
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _large_batch() -> pa.RecordBatch:
    rng = np.random.default_rng(5)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 9, 3000)]
    texts = [" ".join(words[i] for i in rng.integers(0, 3000, 300)) for _ in range(2500)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})


def test_a_worker_tokenizes_a_large_batch_in_little_memory():
    batch = _large_batch()
    assert batch.nbytes > 4 << 20
    textbytes.release_memory()
    stage = token_files._tokenize_stage(tokenizer_path(), END_ID)
    got = []
    assert _peak_mb(lambda: got.extend(b.column("n_tokens") for b in stage([batch]))) < 60
    assert sum(map(len, got)) == batch.num_rows
    textbytes.release_memory()


def test_a_worker_scans_a_large_batch_in_little_memory_and_forgets_its_tables():
    text = _large_batch().column("text")
    textbytes.release_memory()
    n = []

    def work():
        n.extend(len(w.hashes()) for w in textbytes.scan(text, textbytes.ALNUM, True))

    assert _peak_mb(work) < 40
    assert sum(n) == 300 * len(text)
    textbytes.release_memory()
    assert sum(p.nbytes for p in textbytes._powers) < 1000


@pytest.mark.parametrize("part", ["normalizer", "prefix", "dropout", "no regex"])
def test_other_tokenizers_take_the_librarys_plain_way(tmp_path, part):
    config = json.loads(Path(tokenizer_path()).read_text())
    if part == "normalizer":
        config["normalizer"] = {"type": "Lowercase"}
    elif part == "dropout":
        config["model"]["dropout"] = 0.5
    else:
        config["pre_tokenizer"].update({"add_prefix_space": True} if part == "prefix" else {"use_regex": False})
    (tmp_path / "other.json").write_text(json.dumps(config))
    assert not PieceEncoder(str(tmp_path / "other.json")).by_piece
    assert PieceEncoder(tokenizer_path()).by_piece


@pytest.mark.parametrize("seed", range(6))
def test_huffman_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 900, 40)
    n[rng.integers(0, 40, 5)] = 0
    bounds = np.concatenate(([0], np.cumsum(n)))
    ids = (rng.zipf(1.2, bounds[-1]) % [1, 2, 50, 3000, 40000, 9][seed]).astype(np.int64)
    counts = np.bincount(ids, minlength=3)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= 16 and (0.5 ** lengths[lengths > 0].astype(float)).sum() <= 1
    codes, _ = huffman.canonical_codes(lengths)
    bits, at, marks, _ = huffman.encode(ids, bounds, lengths, codes)
    got = huffman.decode(bits, at, n, marks, huffman.decode_table(lengths))
    assert (got == ids).all()


def test_lengths_are_optimal_when_the_limit_does_not_bind():
    import heapq
    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1])
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    assert int((counts * huffman.code_lengths(counts)).sum()) == cost
    fibonacci = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    assert huffman.code_lengths(fibonacci, 5).max() == 5


def _digest(spark, rows, extra="n_tokens string"):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], f"doc_id long, text string, {extra}")
    folder = scratch_path(spark, "token-test")
    token_files.write_token_files(df.repartition(3), folder, tokenizer_path(), END_ID,
                                  block_tokens=500)
    return sorted(map(tuple, token_files.read_token_files(spark, folder).collect()),
                  key=lambda r: r[1])


def test_files_hold_every_document_in_order(spark):
    rows = [(10 * (i % 9) if i != 5 else None, t) for i, t in enumerate(TEXTS)]
    enc = PieceEncoder(tokenizer_path())
    want = []
    for i, t in rows:
        ids = np.array(enc.plain([t or ""])[0] + [END_ID], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    got = _digest(spark, rows)
    assert sorted(((r[0], r[2], r[3]) for r in got), key=repr) == sorted(want, key=repr)
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    assert [r[1] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])))[:-1].tolist()


def test_empty_table(spark):
    assert _digest(spark, []) == []


def test_the_models_alphabet_is_the_librarys():
    enc = PieceEncoder(tokenizer_path())
    pieces = [chr(c) * k for c in [*range(0x20, 0x250), 0x4E2D, 0x1F600, 0x20AC] for k in (1, 3)]
    pieces = [p for p in pieces if len(enc.library.pre_tokenizer.pre_tokenize_str(p)) == 1]
    assert len(pieces) > 900 and enc.by_model(pieces) == enc.plain(pieces)


def test_any_number_of_used_ids_round_trips():
    rng = np.random.default_rng(3)
    used = 200_000
    n = np.array([60_000, 0, 150_000, 256, 1, 39_743, 90_000])
    ids = np.concatenate((rng.permutation(used), (rng.zipf(1.3, int(n.sum()) - used) % used))).astype(np.int64)
    rng.shuffle(ids)
    lengths = huffman.code_lengths(np.bincount(ids))
    assert 17 < lengths.max() <= huffman.LONGEST and (lengths > 0).sum() == used
    assert (0.5 ** lengths[lengths > 0].astype(float)).sum() <= 1
    codes, _ = huffman.canonical_codes(lengths)
    bounds = np.concatenate(([0], np.cumsum(n)))
    bits, at, marks, _ = huffman.encode(ids, bounds, lengths, codes)
    assert (huffman.decode(bits, at, n, marks, huffman.decode_table(lengths)) == ids).all()
    flat = huffman.code_lengths(np.ones(70_000, np.int64))        # more ids than 16 bits have codes
    assert flat.max() == 17 and (flat > 0).all()


def test_parts_are_ranges_also_where_one_row_is_repeated(spark):
    rows = [(7, "same words")] * 300 + [(i, f"text {i}") for i in range(40)] + [(None, "x")] * 20
    got = _digest(spark, rows)
    assert len(got) == 360 and [r[0] for r in got] == [None] * 20 + sorted(r[0] for r in rows if r[0] is not None)
    assert [r[1] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])))[:-1].tolist()
    tokens = spark.createDataFrame([(r[0], 2, 5) for r in rows], "doc_id long, n_tokens long, crc long")
    bounds = token_files.part_bounds(tokens, 8)
    assert len(bounds) == 7 and bounds == sorted(bounds) and len(set(bounds)) < 7
    assert token_files.part_bounds(tokens.limit(0), 8) == []
