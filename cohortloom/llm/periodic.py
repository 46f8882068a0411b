"""Operator 13: periodic runs of words by Baier grouping.

A run is a stretch of words with smallest period p (words p apart are
equal), of ``LEAST_WORDS`` words and ``LEAST_PERIODS`` periods or more, that
neither neighbouring word extends. Every run holds an occurrence of its
Lyndon root, the least rotation of one period, and under one of two
opposite word orders that root is the longest Lyndon word that starts
there. So both orders' Lyndon words give all runs:

 1. Phase one of Baier's suffix sorter groups the positions of a text by
    their longest Lyndon word. Groups start as the words' classes and are
    taken from the highest to the lowest. The nearest position to the left
    in a lower group takes the group's Lyndon words into its own and moves
    to a new group just above its old one, farther up the more it takes.
    What is left of a group when its turn comes has one common Lyndon word,
    so the lengths and the groups are the Lyndon array, with no second
    phase. Texts of a chunk stand in one string, parted by a mark below
    all words; words are ordered by first occurrence, and then backwards.
 2. Two neighbouring occurrences of a root are two positions of one group,
    one root length apart. Such neighbours form chains.
 3. The common extensions of a chain's first and last root to the left and
    right give the run. Each is less than a root, as a further whole root
    would be in the chain.

A run of k periods holds each of its words k times at least, so a word that
its text has fewer times is in no run. Such words are marks as well, and
stretches between marks that are too short for a run are left out before
the grouping, which spares most of a natural text.

Documents are independent of each other, so the plan has no shuffle, and a
hot source or a group of copies costs what its texts cost.

Defined results: null, empty and blank texts have no words and no runs;
ties of exponent go to the smaller start, then the smaller period; repeated
rows give a row each; a null id is reported as null; extra columns are
ignored; an empty table gives an empty table. A text is held by one task as
a whole (some 200 bytes a word).
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import common as C

LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words of the texts that are grouped at a time; a longer text stands alone.
CHUNK = 1 << 16

SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>")


def lyndon_groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length, group) of the longest Lyndon word at each position.

    ``codes`` starts with a 0, and 0 is a mark below all words. Two
    positions share a group if and only if they share their Lyndon word;
    marks are left out (length 1, group 0).
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    size_of = np.zeros(n, np.int64)
    size_of[first] = np.diff(np.r_[first, n])
    start = np.empty(n, np.int64)
    start[order] = np.repeat(first, size_of[first])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    marks = int(size_of[0])
    at, place, start, size = order.tolist(), place.tolist(), start.tolist(), size_of.tolist()
    before, length = [0] * n, [1] * n
    high = n
    while high > marks:
        low = start[at[high - 1]]
        if high - low == 1:
            i = at[low]
            p = i - 1
            while start[p] >= low:
                p = before[p]
            before[i] = p
            s = start[p]
            if s:
                length[p] += length[i]
                k = size[s]
                if k > 1:        # to a group of its own, just above the rest of its old one
                    k -= 1
                    size[s] = k
                    end = s + k
                    other, here = at[end], place[p]
                    at[here], place[other] = other, here
                    at[end], place[p] = p, end
                    start[p], size[end] = end, 1
        else:
            taken = Counter()
            members = at[low:high]
            members.sort()
            for i in members:
                p = i - 1
                while start[p] >= low:
                    p = before[p]
                before[i] = p
                if start[p]:
                    taken[p] += 1
            own = length[members[0]]
            by_times: dict[int, dict[int, list[int]]] = {}
            for p, times in taken.items():
                length[p] += times * own
                by_times.setdefault(times, {}).setdefault(start[p], []).append(p)
            for times in sorted(by_times, reverse=True):
                for s, moved in by_times[times].items():
                    left = size[s] - len(moved)
                    if not left:
                        continue
                    size[s] = left
                    new = end = s + left
                    size[new] = len(moved)
                    for p in moved:
                        start[p] = new
                    # the group's tail becomes the new group
                    outside = [p for p in moved if place[p] < new]
                    if outside:
                        chosen = set(moved)
                        stay = [q for q in at[new:new + len(moved)] if q not in chosen]
                        for p, q in zip(outside, stay, strict=True):
                            a, b = place[p], place[q]
                            at[a], at[b], place[p], place[q] = q, p, b, a
        high = low
    return np.array(length, np.int64), np.array(start, np.int64)


def _common(codes: np.ndarray, a: int, b: int, step: int) -> int:
    """Words that agree from ``a`` and ``b`` on, to the right or left."""
    n, size = 0, 32
    while True:
        if step > 0:
            size = min(size, len(codes) - b - n)
            x, y = codes[a + n:a + n + size], codes[b + n:b + n + size]
        else:
            size = min(size, a - n + 1)
            x, y = codes[a - n - size + 1:a - n + 1][::-1], codes[b - n - size + 1:b - n + 1][::-1]
        if size <= 0:
            return n
        bad = np.flatnonzero((x != y) | (x == 0))
        if len(bad):
            return n + int(bad[0])
        n, size = n + size, 2 * size


def runs_of(codes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """Sorted (start, length, period) of the runs of ``codes``, texts of
    codes from 1 on, each after a 0. Two periods show one root only in part
    of the cases, so ``least_periods`` starts at 3."""
    if least_periods < 3:
        raise ValueError("runs are found from three periods on")
    codes = np.asarray(codes, np.int64)
    found = set()
    n = len(codes)
    top = int(codes.max(initial=0)) + 1
    for ranked in (codes, np.where(codes > 0, top - codes, 0)):
        length, group = lyndon_groups(ranked)
        i = np.arange(n)
        nxt = i + length
        again = (group > 0) & (nxt < n)
        again[again] = group[nxt[again]] == group[again]
        pairs = np.flatnonzero(again)           # a root and the same root after it
        if not len(pairs):
            continue
        period = length[pairs]
        back = pairs - period
        head = ~((back >= 0) & again[back] & (length[back] == period))
        for a, p in zip(pairs[head].tolist(), period[head].tolist()):
            b = a + p
            while again[b]:
                b += p
            if b + p - a + 2 * p - 2 < max(least_words, least_periods * p):
                continue
            left = _common(codes, a - 1, a + p - 1, -1)
            right = _common(codes, b, b + p, 1) if b + p < n else 0
            size = left + b + p - a + right
            if size >= max(least_words, least_periods * p):
                found.add((a - left, size, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_tail(words: list[bytes], doc_id) -> list[bytes]:
    """The query's rule: every tenth text (by crc32 of its id) gets a
    periodic tail. A text without id stays."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _digest(doc_id, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    best = (None, None, None, None)
    kept = words
    if runs:
        top = runs[0]
        for r in runs[1:]:          # sorted by start and period, so a tie stays with the first
            if r[1] * top[2] > top[1] * r[2]:
                top = r
        best = (*top, 1000 * top[1] // top[2])
        keep = np.ones(len(words), bool)
        for s, size, p in runs:
            keep[s + p:s + size] = False
        kept = [w for w, k in zip(words, keep.tolist()) if k]
    lines = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
    return (doc_id, len(words), len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(), [{"start": s, "length": size, "period": p} for s, size, p in runs])


def _stretches(codes: np.ndarray, text: np.ndarray, least_words: int, least_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, places) of the stretches that may hold a run, each after a
    0. ``text`` numbers each word's text; a mark's place is -1."""
    _, kind, times = np.unique(text * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True, return_counts=True)
    often = times[kind] >= least_periods
    first = often & np.r_[True, ~often[:-1] | (text[1:] != text[:-1])]
    starts = np.flatnonzero(first)
    stretch = np.cumsum(first) - 1
    size = np.bincount(stretch[often], minlength=len(starts) + 1)
    used = np.flatnonzero(often & (size[stretch] >= least_words))
    mark = np.flatnonzero(np.r_[True, stretch[used][1:] != stretch[used][:-1]]) if len(used) else used
    out, place = np.insert(codes[used], mark, 0), np.insert(used, mark, -1)
    return np.r_[out, 0], np.r_[place, -1]


def _chunk(rows: list[tuple], limits: tuple[int, int]) -> list[tuple]:
    seen: dict[bytes, int] = {}
    codes: list[int] = []
    off = [0]
    for _, words in rows:
        codes.extend([seen.setdefault(w, len(seen) + 1) for w in words])
        off.append(len(codes))
    mine: list[list] = [[] for _ in rows]
    if codes:
        text = np.repeat(np.arange(len(rows)), np.diff(off))
        thin, place = _stretches(np.array(codes, np.int64), text, *limits)
        for s, size, p in runs_of(thin, *limits):
            s = int(place[s])
            mine[text[s]].append((s - off[text[s]], size, p))
    return [_digest(doc_id, words, mine[k]) for k, (doc_id, words) in enumerate(rows)]


def _table(rows: list[tuple]) -> pa.RecordBatch:
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    kinds = [pa.int64()] * 7 + [pa.string()] * 2 + [run]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def find_runs(docs: DataFrame, rewrite=None, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_runs, the run of the greatest exponent, digests of
    the runs and of the text without repetitions, and the runs.

    ``rewrite(words, doc_id)`` may change a text's words first.
    """
    def search(batches):
        for batch in batches:
            waiting, words_in = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(words, doc_id)
                if waiting and words_in + len(words) > CHUNK:
                    yield _table(_chunk(waiting, (least_words, least_periods)))
                    waiting, words_in = [], 0
                waiting.append((doc_id, words))
                words_in += len(words)
            if waiting:
                yield _table(_chunk(waiting, (least_words, least_periods)))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(search, SCHEMA))
