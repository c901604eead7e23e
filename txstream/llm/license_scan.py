"""License scans: exact set-similarity join of text blocks with license templates.

A text is cut into blocks of consecutive words that overlap by half (any stretch of
half a block lies inside one).  A template matches a block that contains at least
``threshold`` of its distinct words; a notice of fewer than 8 words has threshold 1 (six of
the seven words of "Licensed under CC BY-NC 4.0" are the notice "Licensed under CC BY 4.0",
at 0.8 each text under the one would be under the other).  Words are ordered by their frequency in all
documents (counted first, only for template words), and of each template only the
|T| - need + 1 rarest words are looked up (prefix filter); blocks with fewer than
``need`` words are skipped (length filter); the words are then compared in that order
and given up as soon as the rest cannot reach ``need`` (positional filter).  No block
that meets the threshold is missed, and matches are verified on the words themselves.
Where a block matches two notices of which one has all words of the other and more, the
shorter one gives its label only if the block still matches it without the places (shortest
stretches with the words that are needed) of the longer one.

Phrases are templates of threshold 1 whose words must also stand one after another;
every such place is counted.

Defined results: null and empty texts have no words and no label; repeated rows are
scanned alike; equal places of different phrases count each; an empty table gives no
row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txstream.llm import textbytes as tb
from txstream.llm.decontaminate import words_of

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening words of public license notices and their labels.
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            " software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in"
               " compliance with the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms"
            " of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are"
            " permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
            " without fee is hereby granted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]     # in order; a phrase keeps them, a notice is a set
    need: int                  # distinct words a block must contain
    phrase: bool


def templates(threshold: float = 0.8) -> list[Template]:
    out = [Template(label, tuple(p.split()), len(set(p.split())), True) for p, label in PHRASES.items()]
    for label, text in NOTICES:
        words = tuple(dict.fromkeys(words_of(text)))
        # very short notices must be there in full: they differ in one word
        need = len(words) if len(words) < 8 else math.ceil(threshold * len(words) - 1e-9)
        out.append(Template(label, words, need, False))
    return out


def _hash_words(words: list[str]) -> np.ndarray:
    return np.concatenate([w.hashes() for w in tb.scan(pa.array(words), tb.ALNUM, True)])


def _vocabulary(marks: list[Template]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct template words, their hashes sorted, and the order of that sort."""
    words = sorted({w for t in marks for w in t.words})
    h = _hash_words(words)
    order = np.argsort(h)
    return words, h[order], order


def _ids(h: np.ndarray, sorted_hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Template word number of every word, -1 for others."""
    at = np.minimum(np.searchsorted(sorted_hashes, h), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == h, order[at], -1)


def _frequency_stage(marks: list[Template]):
    """Arrow stage: texts -> documents of this task that contain each template word."""
    words, hashes, order = _vocabulary(marks)

    def run(batches):
        total = np.zeros(len(words), np.int64)
        for b in batches:
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                ids = _ids(w.hashes(), hashes, order)
                hit = ids >= 0
                pair = np.unique(w.docs()[hit] * len(words) + ids[hit])
                total += np.bincount(pair % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(total)], ["word", "n"])

    return run


def frequencies(docs: DataFrame, marks: list[Template]) -> dict[str, int]:
    """Document frequency of every template word over all documents (one row a word)."""
    got = (docs.select("text").mapInArrow(_frequency_stage(marks), "word string, n long")
           .groupBy("word").agg(F.sum("n").alias("n")).collect())
    return {r["word"]: r["n"] for r in got}


def _scan_stage(marks: list[Template], frequency: dict[str, int], block: int):
    words, hashes, order = _vocabulary(marks)
    number = {w: i for i, w in enumerate(words)}
    rarity = {w: (frequency.get(w, 0), w) for w in words}
    ordered = [[number[w] for w in sorted(set(t.words), key=rarity.get)] for t in marks]
    prefix = [set(o[:len(o) - t.need + 1]) for o, t in zip(ordered, marks, strict=True)]
    by_word = [[k for k in range(len(marks)) if i in prefix[k]] for i in range(len(words))]
    looked_up = np.array([bool(x) for x in by_word])
    half = block // 2

    wider = [{j for j, u in enumerate(marks) if not u.phrase and set(t.words) < set(u.words)}
             for t in marks]      # notices that contain a notice's words and more

    def place(part: np.ndarray, k: int) -> slice | None:
        """The shortest stretch with the words a template needs; None if there is none."""
        own, seen, best = set(ordered[k]), Counter(), None
        at = [p for p in np.flatnonzero(part >= 0).tolist() if part[p] in own]
        left = 0
        for p in at:
            seen[part[p]] += 1
            while len(seen) >= marks[k].need:
                if best is None or p + 1 - at[left] < best.stop - best.start:
                    best = slice(at[left], p + 1)
                seen[part[at[left]]] -= 1
                if not seen[part[at[left]]]:
                    del seen[part[at[left]]]
                left += 1
        return best

    def apart(part: np.ndarray, k: int, longer: list[int]) -> bool:
        """The block matches notice k beside all places of the longer ones."""
        rest = part.copy()
        for j in longer:
            while (x := place(rest, j)) is not None:
                rest[x] = -1
        return place(rest, k) is not None

    def search(ids: np.ndarray, text_of) -> tuple[list, set, float]:
        """Phrase places, labels and best containment of one document."""
        candidates = {(b, k) for p in np.flatnonzero((ids >= 0) & looked_up[ids])
                      for b in {p // half, max(0, p // half - 1)} for k in by_word[ids[p]]}
        places, found, best = set(), set(), 0.0
        for b, k in sorted(candidates):
            t, part = marks[k], ids[b * half:b * half + block]
            if len(part) < t.need:
                continue
            there, got = set(part[part >= 0].tolist()), 0
            for i, word in enumerate(ordered[k]):
                got += word in there
                if got + len(ordered[k]) - i - 1 < t.need:
                    break
            else:
                if t.phrase:
                    seq = [number[w] for w in t.words]
                    for s in np.flatnonzero(part[:len(part) - len(seq) + 1] == seq[0]):
                        at = b * half + int(s)
                        if part[s:s + len(seq)].tolist() == seq and all(
                                text_of(at + j) == w for j, w in enumerate(t.words)):
                            places.add((at, k))
                else:
                    found.add((b, k))
                    best = max(best, got / len(ordered[k]))
        # where they share a place the more specific notice speaks for it
        labels = set()
        for b, k in sorted(found):
            longer = [j for j in sorted(wider[k]) if (b, j) in found]
            if marks[k].label not in labels and (
                    not longer or apart(ids[b * half:b * half + block], k, longer)):
                labels.add(marks[k].label)
        return sorted(places), labels, best

    def run(batches):
        for b in batches:
            for w in tb.scan(b.column("text"), tb.ALNUM, True):
                ids = _ids(w.hashes(), hashes, order)
                hits = np.flatnonzero((ids >= 0) & looked_up[ids])
                owners = set((np.searchsorted(w.bounds, hits, side="right") - 1).tolist())
                rows = []
                for i in range(w.n_docs):
                    if i not in owners:
                        rows.append((0, None, None, "", "", 0.0))
                        continue
                    a, z = w.bounds[i], w.bounds[i + 1]
                    places, labels, best = search(ids[a:z], lambda j, a=a: w.data[
                        w.starts[a + j]:w.ends[a + j]].tobytes().decode("utf-8", "replace"))
                    base = {marks[k].label for _, k in places}
                    rows.append((len(places), places[0][0] if places else None,
                                 places[-1][0] if places else None, ",".join(sorted(base)),
                                 ",".join(sorted(base | labels)), 1.0 if base else best))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[w.first_doc:w.first_doc + w.n_docs], pa.array(w.counts),
                     pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()),
                     pa.array(cols[4], pa.string()), pa.array(cols[5], pa.float64())],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word",
                           "base_labels", "labels", "score"])

    return run


def scan_licenses(docs: DataFrame, marks: list[Template] | None = None) -> DataFrame:
    """Per document: words, phrase places, labels and the best containment."""
    marks = marks or templates()
    block = 4 * max(len(t.words) for t in marks)
    return docs.select("doc_id", "text").mapInArrow(
        _scan_stage(marks, frequencies(docs, marks), block),
        "doc_id long, n_words long, n_base long, first_word long, last_word long,"
        " base_labels string, labels string, score double")
