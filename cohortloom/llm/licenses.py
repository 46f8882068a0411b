"""Operator 3: licence scans with a generalised suffix automaton.

All licence templates are put into one suffix automaton over words. A text
streams through it, which gives the matching statistics: for each word,
the longest run ending there that occurs in some template, and where. Runs
that cannot be made longer and have ``MIN_MATCH`` words are chained, per
template and in both orders, into a covered template span; a template
whose words are covered to ``COVERED`` gives its label. Base phrases are
templates too: each place where the run ending there holds a phrase as a
suffix counts.

Only stretches of two or more template words are streamed, since no phrase
or run is shorter. The automaton is built from the fixed templates below
and travels with the task, so nothing grows with the documents, and no
text leaves its partition.

Defined results: null text is empty; texts without words have counts 0, no
places (null), empty labels and score 0; score is the largest covered
share of a template; repeated rows are scanned row by row; extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import common as C

#: Base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Licence notices (label, text).
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("mit", "Licensed under the MIT License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
MIN_MATCH = 3
COVERED = 0.8
MAX_GAP = 6

_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, spans string")


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.size, self.ends = [{}], [-1], [0], [set()]
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                self.ends[last].add((number, at))
        for s in sorted(range(1, len(self.size)), key=lambda x: -self.size[x]):
            self.ends[self.link[s]] |= self.ends[s]

    def _state(self, size, nxt, link):
        self.next.append(nxt)
        self.size.append(size)
        self.link.append(link)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, p, word, q):
        copy = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last, word):
        q = self.next[last].get(word)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, word, q)
        new, p = self._state(self.size[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
        return new

    def stream(self, words):
        """(state, length) of the longest run ending at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            to = self.next[state].get(word)
            if to is not None:
                state, length = to, length + 1
            yield state, length


def _hashes(text: str) -> list[int]:
    data, off = C.text_bytes(pa.array([text]))
    return C.words(data, off, C.PLAIN_WORDS)[2].tolist()


@functools.cache
def _model(base, templates):
    phrases = [_hashes(p) for p, _ in base]
    texts = [_hashes(t) for _, t in templates]
    auto = Automaton(phrases + texts)
    whole = [[(n, len(phrases[n])) for n, at in sorted(e) if n < len(phrases) and at + 1 == len(phrases[n]) == auto.size[s]]
             for s, e in enumerate(auto.ends)]
    for s in sorted(range(1, len(whole)), key=lambda x: auto.size[x]):
        whole[s] = whole[s] + whole[auto.link[s]]  # suffixes of the run
    runs = [[(n - len(phrases), at) for n, at in sorted(e) if n >= len(phrases)] for e in auto.ends]
    vocabulary = np.array(sorted({h for t in phrases + texts for h in t}), dtype=np.uint64)
    return auto, whole, runs, vocabulary, [len(t) for t in texts]


def _chains(matches, sizes):
    """Best (covered words, first, last) per template from its matches
    (template start, length, text start)."""
    out = {}
    for t, found in matches.items():
        found.sort(key=lambda m: (m[2], m[0]))
        best = []
        for i, (a, n, x) in enumerate(found):
            score, head = n, x
            for j in range(i - 1, -1, -1):
                b, k, y = found[j]
                if x - (y + k) > MAX_GAP + sizes[t]:
                    break
                over = max(0, b + k - a, y + k - x)
                if b < a and y < x and over < n and x - (y + k) <= MAX_GAP and best[j][0] + n - over > score:
                    score, head = best[j][0] + n - over, best[j][1]
            best.append((score, head, x + n))
        out[t] = max(best, key=lambda z: z[0])
    return out


def _scan(base, templates):
    def run(batches):
        auto, whole, runs, vocabulary, sizes = _model(base, templates)
        quick = np.zeros(1 << 16, bool)
        quick[vocabulary & np.uint64(0xFFFF)] = True
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for lo, hi in C.row_chunks(off):
                _, _, h, woff = C.words(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], C.PLAIN_WORDS)
                hit = quick[h & np.uint64(0xFFFF)]
                at = np.flatnonzero(hit)
                at = at[vocabulary[np.minimum(np.searchsorted(vocabulary, h[at]), len(vocabulary) - 1)] == h[at]]
                row = np.searchsorted(woff, at, "right") - 1
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(row) != 0)
                first = np.flatnonzero(new)
                size = np.diff(np.append(first, len(at)))
                places, matches = {}, {}
                for s, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
                    r, start = int(row[s]), int(at[s] - woff[row[s]])
                    stream = list(auto.stream(h[at[s]:at[s] + n].tolist()))
                    for i, (state, length) in enumerate(stream):
                        for p, k in whole[state]:
                            if k <= length:
                                places.setdefault(r, []).append((start + i - k + 1, p))
                        if length >= MIN_MATCH and (i + 1 == n or stream[i + 1][1] <= length):
                            for t, end in runs[state]:
                                matches.setdefault(r, {}).setdefault(t, []).append((end - length + 1, length, start + i - length + 1))
                out = []
                for r in range(hi - lo):
                    got = places.get(r, [])
                    own = {base[p][1] for _, p in got}
                    score, labels, spans = float(bool(got)), set(own), []
                    for t, (cover, a, b) in _chains(matches.get(r, {}), sizes).items():
                        score = max(score, cover / sizes[t])
                        if cover >= COVERED * sizes[t]:
                            labels.add(templates[t][0])
                            spans.append(f"{templates[t][0]}:{a}:{b}")
                    starts = [x for x, _ in got]
                    out.append((int(woff[r + 1] - woff[r]), len(got), min(starts, default=None), max(starts, default=None),
                                ",".join(sorted(own)), ",".join(sorted(labels)), score, ",".join(sorted(set(spans)))))
                cols = list(zip(*out))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo)] + [pa.array(c, k) for c, k in zip(cols, kinds)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES) -> DataFrame:
    """One row per document, see the module text; ``spans`` lists the
    method's label:first word:end word."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(_scan(tuple(base), tuple(templates)), _SCHEMA)
