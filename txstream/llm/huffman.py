"""Canonical length-limited Huffman codes over token ids, vectorised with numpy.

A code is fully given by its lengths; codes of one length are consecutive in the
order of the ids.  Bits are packed from the most significant bit on, every
document starts at a byte, and every ``interval`` tokens the bit offset inside the
document is kept (a checkpoint), so that decoding can start there.  Codes have at most 16
bits, or a few more than the number of used ids needs (2^23 ids at most); decoding looks up the first
16 bits in a table, and the rest of longer codes in the list of first codes by length.
"""

from __future__ import annotations

import numpy as np

MAX_LEN = 16
LONGEST = 25          # a window of four bytes holds it at any bit offset
INTERVAL = 256


def code_lengths(counts: np.ndarray, max_len: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``max_len`` bits (package-merge); 0: unused id.

    By default 16, or two more than the used ids need.
    """
    used = np.flatnonzero(counts)
    if max_len is None:
        max_len = min(LONGEST, max(MAX_LEN, int(len(used)).bit_length() + 2))
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << max_len:
        raise ValueError(f"{n} ids do not fit in codes of {max_len} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, items = [], leaves
    is_leaf = np.ones(n, bool)
    for _ in range(max_len - 1):
        levels.append(is_leaf)
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate((leaves, pairs))
        by = np.argsort(merged, kind="stable")
        items = merged[by]
        is_leaf = by < n
    levels.append(is_leaf)
    take = 2 * n - 2
    out = np.zeros(n, np.int64)
    for flags in reversed(levels):
        n_leaves = int(flags[:take].sum())
        out[:n_leaves] += 1
        take = 2 * (take - n_leaves)
    lengths[order] = out
    return lengths


def canonical_codes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every id, and the used ids in the order of their codes."""
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    codes = np.zeros(len(lengths), np.uint32)
    if len(order):
        size = lengths[order].astype(np.int64)
        # left-aligned codes are the running sum of the space the earlier codes take
        space = np.int64(1) << (size.max() - size)
        left = np.concatenate(([0], np.cumsum(space)[:-1]))
        codes[order] = (left >> (size.max() - size)).astype(np.uint32)
    return codes, order


def encode(ids: np.ndarray, bounds: np.ndarray, lengths: np.ndarray, codes: np.ndarray,
           interval: int = INTERVAL):
    """Bits of all documents (one byte array), byte bounds, checkpoints and their bounds."""
    size = lengths[ids].astype(np.int64)
    if len(ids) and size.min() == 0:
        raise ValueError("an id without a code")
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    doc_bits = total[bounds[1:]] - total[bounds[:-1]]
    byte_bounds = np.concatenate(([0], np.cumsum((doc_bits + 7) // 8)))
    n = np.diff(bounds)
    inside = total[:-1] - np.repeat(total[bounds[:-1]], n)
    at = inside + np.repeat(byte_bounds[:-1] * 8, n)
    n_bytes = 3 if not len(ids) or int(size.max()) <= 17 else 5      # a code lies in so many
    value = codes[ids].astype(np.int64) << (8 * n_bytes - size - (at & 7))
    out = np.zeros(int(byte_bounds[-1]) + n_bytes, np.uint8)
    if len(ids):
        byte = at >> 3
        first = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1])))
        merged = np.bitwise_or.reduceat(value, first)      # tokens that begin in one byte
        for k in range(n_bytes):
            out[byte[first] + k] |= ((merged >> (8 * (n_bytes - 1 - k))) & 255).astype(np.uint8)
    place = np.arange(len(ids)) - np.repeat(bounds[:-1], n)
    marks = np.flatnonzero(place % interval == 0)
    mark_bounds = np.concatenate(([0], np.cumsum((n + interval - 1) // interval)))
    return out[:int(byte_bounds[-1])], byte_bounds, inside[marks].astype(np.uint32), mark_bounds


class Table:
    """Decoding table: ``width`` bits are peeked; the first ``top`` of them index ``ids`` and
    ``size`` (size 0: a longer code).  ``first`` and ``base`` give the longer codes: first code of each
    length, left-aligned to ``width`` bits, and its place in ``order``."""

    def __init__(self, lengths: np.ndarray, top: int = MAX_LEN):
        _, self.order = canonical_codes(lengths)
        size = lengths[self.order].astype(np.int64)
        self.width = int(size.max()) if len(size) else 1
        self.top = min(top, self.width)
        short = int(np.searchsorted(size, self.top, side="right"))
        span = np.int64(1) << (self.top - size[:short])
        ids, used = np.repeat(self.order[:short], span), np.repeat(size[:short], span)
        pad = (1 << self.top) - len(ids)       # longer codes, or what a code of one id leaves open
        last = (self.order[-1], size[-1]) if 0 < short == len(size) else (0, 1 if not len(size) else 0)
        self.ids = np.concatenate((ids, np.full(pad, last[0], np.int64)))
        self.size = np.concatenate((used, np.full(pad, last[1], np.int64)))
        self.long = np.arange(self.top + 1, self.width + 1)
        left = np.concatenate(([0], np.cumsum(np.int64(1) << (self.width - size))))
        self.base = np.searchsorted(size, self.long, side="left")
        self.first = left[self.base]

    def look_up(self, peek: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and code length for peeks of ``width`` bits."""
        head = peek >> (self.width - self.top)
        ids, size = self.ids[head], self.size[head]
        if len(self.long):
            more = np.flatnonzero(size == 0)
            if len(more):
                p = peek[more].astype(np.int64)
                k = np.searchsorted(self.first, p, side="right") - 1
                size[more] = self.long[k]
                ids[more] = self.order[self.base[k] + ((p - self.first[k]) >> (self.width - self.long[k]))]
        return ids, size


def decode_table(lengths: np.ndarray) -> Table:
    """The table of a code."""
    return Table(lengths)


def decode(bits: np.ndarray, byte_bounds: np.ndarray, n_tokens: np.ndarray, marks: np.ndarray,
           table, interval: int = INTERVAL) -> np.ndarray:
    """All ids of the documents; all checkpoint intervals advance together."""
    width = table.width
    if width > LONGEST:
        raise ValueError(f"the peek of four bytes holds {LONGEST} bits at most")
    n_marks = (n_tokens + interval - 1) // interval
    doc = np.repeat(np.arange(len(n_tokens)), n_marks)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_marks) - n_marks, n_marks)
    left = np.minimum(interval, n_tokens[doc] - nth * interval)
    pos = byte_bounds[:-1][doc] * 8 + marks.astype(np.int64)
    padded = np.concatenate((bits, np.zeros(4, np.uint8))).astype(np.uint32)
    window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    order = np.argsort(-left, kind="stable")
    pos, left = pos[order], left[order]
    start = (np.cumsum(n_tokens) - n_tokens)[doc][order] + nth[order] * interval
    out = np.empty(int(n_tokens.sum()), np.int64)
    for step in range(int(left.max()) if len(left) else 0):
        m = int(np.searchsorted(-left, -step, side="left"))   # intervals longer than step
        p = pos[:m]
        peek = (window[p >> 3] >> (32 - width - (p & 7))) & ((1 << width) - 1)
        ids, size = table.look_up(peek)
        out[start[:m] + step] = ids
        pos[:m] = p + size
    return out
