"""Operators 11 to 13 against brute force and odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.llm import periodic, queries, resampling, topk

SF = "/root/testdata/sf0.001"
PLAIN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- operator 11 ------------------------------------------------------------

def buckets_of(text):
    w = PLAIN.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def resampled(rows, target):
    held = [(doc_id, *buckets_of(text)) for doc_id, text in rows]
    s = Counter(b for _, _, f in held for b in f)
    t = Counter(b for text in target for b in buckets_of(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    out = []
    for doc_id, words, f in held:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((-r[3], r[0] is None, r[0] or 0) for r in out if r[4] >= 20)
    drawn = Counter(able[:25 * len(able) // 100])
    ranks = {}
    for i, key in enumerate(able[:25 * len(able) // 100], 1):
        ranks.setdefault(key, []).append(i)
    rows = []
    for doc_id, n, weight, score, words in out:
        key = (-score, doc_id is None, doc_id or 0)
        rank = ranks[key].pop(0) if words >= 20 and drawn[key] > 0 and ranks[key] else None
        rows.append((doc_id, n, weight, score, rank))
    return sorted(rows, key=str)


def test_resampling_equals_brute_force(spark, doc_rows):
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    got = queries.op11_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == resampled(doc_rows, target)


def test_resampling_odd_rows(spark, docs_df):
    long = " ".join(f"Wort{i % 50}-ä{i}" for i in range(40_000))
    rows = [(i, f"alpha {i} " * 15) for i in range(40)]
    rows += [(None, "beta gamma " * 20)] * 3 + [(7, "alpha 7 " * 15)] * 5      # repeated rows, an id for several texts
    rows += [(90, None), (91, ""), (92, "..!"), (93, "one"), (94, "x" * 200_000), (95, long)]
    target = spark.createDataFrame([("beta gamma " * 50, 1), (None, 2)], "text string, score int")
    got = resampling.resample(docs_df(rows), target)
    assert sorted(map(tuple, got.collect()), key=str) == resampled(rows, ["beta gamma " * 50])
    empty = resampling.resample(docs_df([]), target)
    assert empty.columns == got.columns and empty.count() == 0
    no_target = resampling.resample(docs_df(rows), target.limit(0))
    assert sorted(map(tuple, no_target.collect()), key=str) == resampled(rows, [])


@pytest.mark.parametrize("half", [0.0, 1e-6, 0.004, 0.3])
def test_bracket_holds_the_place(spark, half):
    """A bracket that misses is widened; equal scores stay inside it."""
    scores = spark.range(5000).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997)).alias("score"))
    known = sorted((r["score"] for r in scores.collect()), reverse=True)
    for k in (1, 2, 1249, 2500, 5000):
        low, high, above = resampling.bracket(scores, 5000, k, max(half, 1e-9))
        assert low <= known[k - 1] <= high and above == sum(x > high for x in known) < k


def test_numbered_is_a_total_order(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 100).alias("a"), "id")
    got = resampling.numbered(df, F.col("a").desc(), F.col("id").asc()).orderBy("number").collect()
    assert [r["number"] for r in got] == list(range(1, 3001))
    assert [(r["a"], r["id"]) for r in got] == sorted(((r["a"], r["id"]) for r in got), key=lambda x: (-x[0], x[1]))


# --- operator 12 ------------------------------------------------------------

def best_of(rows, k=20, every=20):
    held = []
    for vec_id, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.append((vec_id, [math.floor(64 * x) for x in v]))
    out = []
    for i, (q, a) in enumerate(held):
        if q is None or q % every:
            continue
        all_of = sorted((-sum(x * y for x, y in zip(a, b)), c is None, c or 0) for j, (c, b) in enumerate(held) if j != i)
        out += [(q, r, None if none else c, -s) for r, (s, none, c) in enumerate(all_of[:k], 1)]
    return sorted(out, key=str)


def vectors_df(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, score int")


def test_top_k_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op12_exact_top_k(spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == best_of(rows)


def test_top_k_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=6).tolist()) for i in range(90)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)]                       # a vector that many rows hold: ties
    rows += [(20, rows[20][1]), (40, [1.0] * 6), (-20, [0.25] * 6)]         # repeated row, second row of an id
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0]), (303, [float("nan")] * 6), (304, [float("inf"), 1.0]),
             (305, [2.0, -1.0]), (306, [0.5] * 40), (None, [1.0] * 6), (320, [1e300] * 6), (340, [3e5] * 6), (360, [])]
    got = sorted(map(tuple, topk.top_k(vectors_df(spark, rows), F.col("vec_id") % 20 == 0).collect()), key=str)
    clip = [(q, r, c, max(-2**63, min(2**63 - 1, s))) for q, r, c, s in best_of(rows)]
    small = [x for x in got if abs(x[3]) < 2**62]
    assert {(x[0], x[2], x[3]) for x in small} <= {(x[0], x[2], x[3]) for x in clip}
    assert [x for x in got if x[0] not in (320,) and abs(x[3]) < 2**62] == [x for x in clip if x[0] not in (320,) and abs(x[3]) < 2**62]
    assert Counter(x[0] for x in got) == Counter(x[0] for x in clip)
    few = [(0, [1.0]), (1, [2.0])]
    assert [tuple(r) for r in topk.top_k(vectors_df(spark, few), F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(vectors_df(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_blocks_compact_and_stay_exact():
    """Clustered vectors, where bounds do remove columns, over several blocks."""
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(8, 48)) * 20
    c = np.floor(centre[rng.integers(0, 8, 6000)] + rng.normal(size=(6000, 48)) * 2)
    q = c[::100]
    held = topk.Queries(np.arange(len(q)), np.arange(len(q)) * 100, q, 21)
    for a in range(0, 6000, topk.BLOCK):
        held.meet(np.arange(a, min(a + topk.BLOCK, 6000)), c[a:a + topk.BLOCK].T)
    for i, row in enumerate(q):
        scores = c @ row
        top = np.lexsort((np.arange(6000), -scores))[:21]
        assert held.best_id[i].tolist() == top.tolist() and held.best[i].tolist() == scores[top].tolist()


# --- operator 13 ------------------------------------------------------------

def all_runs(words, least, periods):
    out = set()
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            size = j - i + p
            if j > i and size >= max(least, periods * p):
                w = words[i:i + size]
                if not any(w[q:] == w[:-q] for q in range(1, p)):
                    out.add((i, size, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=40), min_size=1, max_size=3), st.sampled_from([(3, 3), (5, 3), (24, 3), (6, 4)]))
def test_runs_equal_brute_force(texts, limits):
    rows = [(k, [str(x).encode() for x in t]) for k, t in enumerate(texts)]
    for (_, words), out in zip(rows, periodic._chunk(rows, limits)):
        assert [(r["start"], r["length"], r["period"]) for r in out[9]] == all_runs(words, *limits)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=25), min_size=1, max_size=3))
def test_groups_are_lyndon_words(texts):
    codes, at = [0], []
    for t in texts:
        at.append(len(codes))
        codes += t + [0]
    length, group = periodic.lyndon_groups(np.array(codes))
    held = {}
    for o, t in zip(at, texts):
        for i in range(len(t)):
            best = max(n for n in range(1, len(t) - i + 1)
                       if all(t[i:i + n] < t[i + k:i + n] for k in range(1, n)))
            assert length[o + i] == best
            held.setdefault(int(group[o + i]), set()).add(tuple(t[i:i + best]))
    assert all(len(v) == 1 for v in held.values())
    assert len({w for v in held.values() for w in v}) == len(held)


def digest_of(doc_id, text, rewrite=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if rewrite and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = all_runs(words, 24, 3)
    drop = {i for s, size, p in runs for i in range(s + p, s + size)}
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def test_periodic_query_equals_brute_force(spark, doc_rows):
    short = [(i, t) for i, t in doc_rows if len((t or "").split()) < 700]
    got = queries.op13_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    held = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(held) == len(doc_rows) and len(short) > 100
    assert sum(held[i][1] for i, _ in short) > 0
    for i, t in short:
        assert held[i] == digest_of(i, t)


def test_periodic_odd_rows(spark, docs_df):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 23), (5, "a " * 24), (5, "a " * 24), (None, "b c " * 40),
            (7, "x\x0by\x0c " * 30 + "end"), (8, "p q r " * 8 + "s t " * 12)]
    got = periodic.find_runs(docs_df(rows)).drop("n_words", "runs")
    assert Counter(map(tuple, got.collect())) == Counter(digest_of(i, t, rewrite=False) for i, t in rows)
    deep = periodic.find_runs(docs_df([(1, "w " * 300_000 + "v " * 10), (2, "ab cd " * 100_000)])).orderBy("doc_id").collect()
    assert [(r["start"], r["length"], r["period"], r["exponent_milli"]) for r in deep] == [
        (0, 300_000, 1, 300_000_000), (0, 200_000, 2, 100_000_000)]
    assert periodic.find_runs(docs_df([])).count() == 0
    with pytest.raises(ValueError):
        periodic.runs_of(np.array([0, 1, 1, 0]), 2, 2)
