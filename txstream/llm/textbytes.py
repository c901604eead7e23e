"""Vectorised words over the UTF-8 bytes of Arrow string columns.

Word classes whose separators are all ASCII can be decided byte by byte, since
every byte of a multi-byte character is >= 0x80.  A batch is cut into chunks of
whole documents (about ``CHUNK`` bytes, one document at least), so that the
working arrays stay small whatever the batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64


def byte_class(separators: bytes | range | list[int]) -> np.ndarray:
    """256 booleans: True where the byte belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


# [^\x20\x09-\x0D]+
BLANK_SPLIT = byte_class([0x20, *range(0x09, 0x0E)])
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = byte_class([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
# letters only: lower-case a-z and all non-ASCII characters
LETTERS = byte_class([*range(0x61), *range(0x7B, 0x80)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

KEPT: list = []     # callables that drop what a module remembers across tasks


def release_memory(keep=None) -> None:
    """Drop other stages' memories (all of KEPT but ``keep``) and give freed memory back to the system.

    Python workers are reused by later stages, beside an executor's heap; a stage calls
    this when it begins.
    """
    for drop in KEPT:
        if drop is not keep:
            drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # only some C libraries have it
    if trim is not None:
        trim(0)


def trimmed(stage, keep=None):
    """An Arrow stage that begins and ends with :func:`release_memory`: its worker may stand idle beside
    the next stages' heap, and holds little then."""
    def run(batches):
        release_memory(keep)
        yield from stage(batches)
        release_memory(keep)

    return run


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**64, 256, dtype=U)
_BASE = U(0x9E3779B97F4A7C15)                      # odd, so it has an inverse mod 2^64
_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_GRAM = U(0xD1342543DE82EF95)
_powers = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, CHUNK + 4096)
        for k, base in enumerate((_BASE, _INV)):
            p = np.full(m, base, U)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1]


def _forget_powers() -> None:
    _powers[:] = np.ones(1, U), np.ones(1, U)


KEPT.append(_forget_powers)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


@dataclass
class Words:
    """The words of documents ``first_doc .. first_doc + n_docs - 1`` of a batch."""

    first_doc: int
    n_docs: int
    data: np.ndarray      # bytes (lower-cased on request)
    offsets: np.ndarray   # n_docs + 1 byte offsets into data
    starts: np.ndarray    # byte offset of every word
    ends: np.ndarray
    bounds: np.ndarray    # n_docs + 1 word offsets

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def docs(self) -> np.ndarray:
        """Document number (from 0 in this chunk) of every word."""
        return np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, salt: int = 0) -> np.ndarray:
        """64-bit hash of every word's bytes."""
        if not len(self.starts):
            return np.empty(0, U)
        pw, inv = powers(len(self.data))
        table = _BYTE if not salt else mix(_BYTE + U(salt))
        v = table[self.data] * pw
        s = np.empty(len(v) + 1, U)
        s[0] = 0
        np.cumsum(v, out=s[1:])
        h = (s[self.ends] - s[self.starts]) * inv[self.starts]
        return mix(h + (self.ends - self.starts).astype(U) * _GRAM)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k consecutive words inside one document, and their first word."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.empty(0, U), np.empty(0, np.int64)
        g = hashes[:n].copy()
        for j in range(1, k):
            g *= _GRAM
            g += hashes[j:j + n]
        doc_end = np.repeat(self.bounds[1:], self.counts)[:n]
        at = np.flatnonzero(np.arange(n) + k <= doc_end)
        return mix(g[at]), at


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, off, data = column.buffers()
    n, a = len(column), column.offset
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, n + 1, a * 8)
    if data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``size`` bytes, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def scan(column, table: np.ndarray, lower: bool, size: int = CHUNK) -> Iterator[Words]:
    """The words of every text, chunk by chunk; all documents appear."""
    raw, offsets = buffers(column)
    for i, j in chunks(offsets, size):
        data = raw[offsets[i]:offsets[j]]
        off = offsets[i:j + 1] - offsets[i]
        if lower:
            data = LOWER[data]
        inside = table[data]
        edge = np.zeros(len(data) + 1, bool)     # a word may not cross these positions
        edge[off] = True
        before = np.empty(len(data), bool)
        if len(data):
            before[0] = False
            before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(len(data), bool)
        if len(data):
            after[-1] = False
            after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield Words(i, j - i, data, off, starts, ends, np.searchsorted(starts, off))
