"""Whole texts to token ids with the ``tokenizers`` library, each distinct piece once.

A byte-level BPE splits a text into pieces (a word with the space before it, a run
of digits, signs or white space) and encodes every piece for itself.  Texts are
therefore cut into pieces with numpy, and only pieces not seen before by this worker
go through the library, piece by piece to its BPE model.  Texts with anything else that matters (a special token's
string, rare scripts whose classes differ between Unicode versions) and tokenizers of
another kind take the library's plain way.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from txstream.llm.textbytes import KEPT, chunks, powers

U = np.uint64
AT_ONCE = 2048            # pieces or texts given to the library in one call
AT_WORK = 1 << 18         # code points cut into pieces at once: the arrays take some 100 bytes of each
KEEP = 500_000            # distinct pieces a worker remembers; more start a new memory

# Ranges of code points whose classes have long been settled, and the
# contractions and white space of the byte-level pattern.
SETTLED = [(0x0, 0x52F), (0x1E00, 0x206F), (0x20A0, 0x20BF), (0x2100, 0x218B), (0x2190, 0x23F3),
           (0x2500, 0x26FF), (0x3000, 0x303F), (0x3041, 0x3096), (0x30A0, 0x30FF),
           (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
# The byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
ONE_LETTER = "stmd"
TWO_LETTERS = ["re", "ve", "ll"]
WHITE = [0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
         0x2029, 0x202F, 0x205F, 0x3000]

ALPHABET = {b: chr(b) for b in PRINTABLE}
ALPHABET |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in ALPHABET)}
OTHER, LETTER, NUMBER, SPACE, UNSETTLED = range(5)
_cache: dict = {}


def _classes() -> tuple[np.ndarray, np.ndarray]:
    if "classes" not in _cache:
        c = np.full(0x110000, UNSETTLED, np.uint8)
        for a, b in SETTLED:
            for i in range(a, b + 1):
                kind = unicodedata.category(chr(i))
                c[i] = (UNSETTLED if kind == "Cn" else LETTER if kind[0] == "L"
                        else NUMBER if kind[0] == "N" else OTHER)
        c[WHITE] = SPACE
        values = np.random.default_rng(7).integers(1, 2**64, 0x110000, dtype=U)
        _cache["classes"] = c, values
    return _cache["classes"]


def piece_starts(cp: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start flags of the pieces of concatenated texts (offsets: where texts begin, and the end)."""
    n = len(cp)
    begin = np.zeros(n + 1, bool)
    begin[offsets] = True
    start = begin[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # b: first character after white space in the same text; its last blank may join it
    b = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~begin[1:n]) + 1
    start[b - 1] = True
    start[b[cp[b - 1] == 0x20]] = False
    # contractions: an apostrophe that begins a piece, and the letters after it
    q = np.flatnonzero((cp == 0x27) & start)
    if len(q):
        end = offsets[np.searchsorted(offsets, q, side="right")]     # end of the text
        padded = np.concatenate((cp, np.zeros(3, cp.dtype)))
        a, c = padded[q + 1], padded[q + 2]
        one = np.isin(a, [ord(x) for x in ONE_LETTER]) & (q + 1 < end)
        two = np.zeros(len(q), bool)
        for x, y in TWO_LETTERS:
            two |= (a == ord(x)) & (c == ord(y)) & (q + 2 < end)
        for at, size, last in ((q[one], 1, end[one]), (q[two & ~one], 2, end[two & ~one])):
            start[at + 1] = False
            after = at + 1 + size
            after = after[after < last]
            start[after] = True
    return start


class PieceEncoder:
    """Encodes texts; remembers the ids of pieces across batches of a worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, models, pre_tokenizers

        # asked part by part: the whole configuration as Python objects takes 30 MB and more
        self.library = Tokenizer.from_file(path)
        pre, model = self.library.pre_tokenizer, self.library.model
        self.by_piece = (self.library.normalizer is None and type(pre) is pre_tokenizers.ByteLevel
                         and pre.use_regex and not pre.add_prefix_space
                         and type(model) is models.BPE and not model.dropout)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.keys, self.proof = np.empty(0, U), np.empty(0, U)
        self.first, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def plain(self, texts: list[str]) -> list[list[int]]:
        out = []
        for a in range(0, len(texts), AT_ONCE):      # the library's results are large objects
            out += [e.ids for e in self.library.encode_batch_fast(texts[a:a + AT_ONCE],
                                                                  add_special_tokens=False)]
        return out

    def by_model(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces, straight from the library's BPE model."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        shown = b"".join(raw).decode("latin-1").translate(ALPHABET)
        tokenize, at, out = self.library.model.tokenize, 0, []
        for r in raw:
            out.append([t.id for t in tokenize(shown[at:at + len(r)])])
            at += len(r)
        return out

    def _remember(self, keys, proof, pieces) -> None:
        ids = self.by_model(pieces)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        at = np.searchsorted(self.keys, keys)
        first = len(self.pool) + np.concatenate(([0], np.cumsum(size)[:-1]))
        self.pool = np.concatenate((self.pool, np.fromiter(
            (i for x in ids for i in x), np.uint32, int(size.sum()))))
        self.keys = np.insert(self.keys, at, keys)
        self.proof = np.insert(self.proof, at, proof)
        self.first = np.insert(self.first, at, first)
        self.size = np.insert(self.size, at, size)

    def _lookup(self, keys: np.ndarray, proof: np.ndarray):
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        if not len(self.keys):
            return at, np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        same = self.keys[at] == keys
        return at, same & (self.proof[at] == proof), same & (self.proof[at] != proof)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids (uint32) and bounds."""
        if not self.by_piece:
            ids = self.plain(texts)
            return (np.fromiter((i for x in ids for i in x), np.uint32),
                    np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64))
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        parts, counts = [], np.zeros(len(texts), np.int64)
        for i, j in chunks(offsets, AT_WORK):
            got, n = self._chunk(texts[i:j], offsets[i:j + 1] - offsets[i])
            parts.append(got)
            counts[i:j] = n
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32),
                np.concatenate(([0], np.cumsum(counts))))

    def _chunk(self, texts: list[str], offsets: np.ndarray):
        classes, values = _classes()
        joined = "".join(texts)
        odd = np.zeros(len(texts), bool)
        if any(s in joined for s in self.special):
            odd |= [any(s in t for s in self.special) for t in texts]
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes[cp]
        rare = np.flatnonzero(kind == UNSETTLED)
        odd[np.searchsorted(offsets, rare, side="right") - 1] = True
        if odd.any():      # these texts take the plain way, the others the fast one
            fine = np.flatnonzero(~odd)
            ids, n = (self._chunk([texts[k] for k in fine], np.concatenate(
                ([0], np.cumsum([len(texts[k]) for k in fine]))).astype(np.int64))
                if len(fine) else (np.empty(0, np.uint32), np.empty(0, np.int64)))
            cut = np.concatenate(([0], np.cumsum(n)))
            own = dict(zip(fine.tolist(), range(len(fine)), strict=True))
            slow = dict(zip(np.flatnonzero(odd).tolist(),
                            self.plain([texts[k] for k in np.flatnonzero(odd)]), strict=True))
            out = [np.array(slow[k], np.uint32) if k in slow else ids[cut[own[k]]:cut[own[k] + 1]]
                   for k in range(len(texts))]
            return np.concatenate(out), np.array([len(x) for x in out], np.int64)
        if not len(cp):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        starts = np.flatnonzero(piece_starts(cp, kind, offsets))
        ends = np.append(starts[1:], len(cp))
        pw, inv = powers(len(cp))
        s = np.zeros(len(cp) + 1, U)
        np.cumsum(values[cp] * pw, out=s[1:])
        h = (s[ends] - s[starts]) * inv[starts]
        keys, sample, inverse = np.unique(h, return_index=True, return_inverse=True)
        a, b = starts[sample], ends[sample]
        proof = ((b - a).astype(U) << U(42)) | (cp[a].astype(U) << U(21)) | cp[b - 1].astype(U)
        if len(self.keys) + len(keys) > KEEP:
            self.forget()
        at, known, clash = self._lookup(keys, proof)
        new = np.flatnonzero(~known & ~clash)
        if len(new):
            self._remember(keys[new], proof[new],
                           [joined[x:y] for x, y in zip(a[new], b[new], strict=True)])
            at, known, clash = self._lookup(keys, proof)
        if clash.any():      # two pieces of one hash: forget, and go the plain way once
            self.forget()
            ids = self.plain(texts)
            return (np.fromiter((i for x in ids for i in x), np.uint32),
                    np.array([len(x) for x in ids], np.int64))
        row = at[inverse]
        size = self.size[row]
        end = np.cumsum(size)
        index = np.arange(int(end[-1])) + np.repeat(self.first[row] - (end - size), size)
        per_text = np.concatenate(([0], end))[np.searchsorted(starts, offsets)]
        return self.pool[index], np.diff(per_text)


FORGET = _cache.clear
KEPT.append(FORGET)


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    if ("encoder", path) not in _cache:
        _cache["encoder", path] = PieceEncoder(path)
    return _cache["encoder", path]
