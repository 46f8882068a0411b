"""Operators 2, 3, 6: native and streamed text rules against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import xxhash
from cohortloom.llm import licenses, quality, secrets

EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c a b c a b c"), (5, "x\nx\n x\n\ny\ny"), (6, "#tag & <b> | 100% $"),
        (7, "é" * 3 + " ü"), (7, "é" * 3 + " ü"), (8, "word " * 30000), (None, "null id"), (9, "\x0b\x0c\x85 \xa0")]


def measures(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    grams = list(zip(w, w[1:], w[2:]))
    often = Counter(grams)
    covered = {p for i, g in enumerate(grams) if often[g] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_and_verdict(documents, doc_rows, docs_df, labels_df, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = quality.assess(documents, labels).select("row.doc_id", "word_chars", "n_symbols", "n_dup_lines", "j.*").collect()
    texts = dict(doc_rows)
    assert len(out) == len(doc_rows)
    for r in out:
        m = measures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == m
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["score"] >= quality.THRESHOLD)


def ngram_buckets(text):
    """Buckets of all words and word pairs, by XXH64 chained over the words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    two = [xxhash.xxh64_intdigest(w.encode(), h) for h, w in zip(one, words[1:])]
    return [h % quality.BUCKETS for h in one + two]


def test_quality_scores_equal_brute_force(documents, doc_rows, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    trusted = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    raw, target = Counter(), Counter()
    held = {i: ngram_buckets(t) for i, t in doc_rows}
    for i, found in held.items():
        raw.update(found)
        if i in trusted:
            target.update(found)
    r, t, prior = raw.total(), target.total(), quality.PRIOR * quality.BUCKETS
    assert 0 < t < r
    # (target + prior * raw share) / (all target + prior), against the raw share
    weight = {b: math.log((target[b] + prior * n / r) / (t + prior) / (n / r)) for b, n in raw.items()}
    rows = quality.assess(documents, labels).select("row.doc_id", "j.*").collect()
    assert len(rows) == len(held) and any(r["score"] < 0 for r in rows) and any(r["score"] > 0 for r in rows)
    for row in rows:
        found = held[row["doc_id"]]
        want = sum(weight[b] for b in found) / len(found) if found else 0.0
        assert abs(row["score"] - want) < 1e-9


def test_quality_held_out_accuracy(documents, spark):
    """Weights from even ids tell good from bad labels of odd ids."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.assess(docs, labels.where("doc_id % 2 = 0")).select("row.doc_id", "j.*")
    rows = out.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert len(good) > 100 and sum(good) >= 0.98 * len(good)
    assert len(bad) > 20 and sum(bad) <= 0.4 * len(bad)


def test_quality_edges(docs_df, labels_df):
    df = docs_df(EDGE)
    out = quality.assess(df, labels_df([(1, 1), (1, 0), (None, 1)])).select("row.*", "j", "n_symbols").collect()
    assert sorted(str((r["doc_id"], r["j"]["n_words"], r["n_symbols"], r["j"]["n_repeat_words"])) for r in out) == sorted(
        str((i, measures(t)[0], measures(t)[2], measures(t)[4])) for i, t in EDGE)
    assert quality.keep_good(df, labels_df([])).columns == df.columns
    assert quality.keep_good(docs_df([]), labels_df([])).count() == 0


ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def check_secrets(rows, texts):
    for r in rows:
        want = base_spans(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = Counter(s.split(":")[0] for s in want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(kinds[k] for k in secrets.KINDS[:3])
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(want) <= set(spans) and len(spans) == len(want) + r["n_markov"]


def test_secret_spans(documents, doc_rows, docs_df, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = secrets.scan(documents, labels).collect()
    assert len(out) == len(doc_rows)
    check_secrets(out, dict(doc_rows))
    rng = random.Random(3)
    key = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    planted = [(10**6 + i, f"ünder the therating {key(32)} and erblesh") for i in range(40)]
    plain = [(2 * 10**6 + i, t) for i, t in enumerate(["internationalizationframework", "get_user_account_settings_by_name",
                                                        "thesereingandthatherblesting"] * 5)]
    odd = [(3, None), (4, ""), (5, "token=abc token=abcdef PassWord : 'x1x2x3x4' passwd = secret=abcdefgh password=token:abcdefgh"),
           (6, "AKIAAKIA" + "A1" * 8 + " AKIA1 " + "f" * 24 + "g" + "0" * 23), (7, "🙂 api_key=" + "z" * 70000), (8, "tOKEN='" + "a" * 6)]
    out = secrets.scan(documents.select("doc_id", "text").where("doc_id > 20").union(docs_df(planted + plain + odd).select("doc_id", "text")),
                       labels).where("doc_id >= 1000000 or doc_id < 10").collect()
    check_secrets([r for r in out if r["doc_id"] < 10], dict(odd))
    assert sum(r["n_markov"] for r in out if 10**6 <= r["doc_id"] < 2 * 10**6) >= 38
    assert sum(r["n_markov"] for r in out if r["doc_id"] >= 2 * 10**6) == 0
    assert secrets.scan(docs_df([]), labels).count() == 0


def test_markov_spans_equal_brute_force(documents, doc_rows, docs_df, spark):
    """Runs, models and scores recomputed in plain Python; texts with many
    matches, long runs and columns of clashing names included."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rng = random.Random(5)
    key = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-") for _ in range(n))
    odd = [key(30) + "0123456789abcdef01234567" + key(30), "x" + key(25) + " token=" + key(25) + "." + key(40) + " " + key(22),
           "AKIA" + "A1" * 10 + "q" * 30 + " " + key(21) + "\x01" + key(21), "é" + " ".join(key(24) for _ in range(3000)),
           " ".join("secret=" + key(9) for _ in range(3000)) + " " + key(20), key(1 << 20), "\x01" * 3 + key(20) + "deadbeef" * 3 + "!"]
    extra = docs_df([(10**6 + i, t) for i, t in enumerate(odd)]).select("doc_id", "text")
    docs = documents.select("doc_id", "text").union(extra).selectExpr("*", "doc_id as id", "text as m", "1 as s", "2 as secret", "3 as `table`", "4 as x")
    sample = [(r["s"], r["secret"]) for r in secrets.samples(docs, labels).collect()]
    counts = {1: Counter(), 0: Counter()}
    for s, secret in sample:
        counts[secret].update(zip(s, s[1:]))
    firsts = {k: Counter() for k in counts}
    for k, c in counts.items():
        for (a, _), n in c.items():
            firsts[k][a] += n
    alpha = {1: secrets.ALPHA_RANDOM, 0: secrets.ALPHA_WORD}
    chance = lambda k, a, b: (counts[k][a, b] + alpha[k]) / (firsts[k][a] + alpha[k] * secrets.SYMBOLS)
    texts = dict(doc_rows) | {10**6 + i: t for i, t in enumerate(odd)}
    out = secrets.scan(docs, labels).collect()
    assert len(out) == len(texts) and sum(r["n_markov"] for r in out) > 2500
    check_secrets(out, texts)
    for r in out:
        text = texts[r["doc_id"]] or ""
        covered = [False] * len(text)
        for x in r["found"]:
            if x["kind"] < 3:
                covered[x["start"]:x["stop"]] = [True] * (x["stop"] - x["start"])
        want = []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
            if not any(covered[m.start():m.end()]):
                mean = sum(math.log(chance(1, a, b) / chance(0, a, b)) for a, b in zip(m[0], m[0][1:])) / (len(m[0]) - 1)
                assert abs(mean - secrets.THRESHOLD) > 1e-9
                want += [(m.start(), m.end(), m[0])] if mean >= secrets.THRESHOLD else []
        assert [(x["start"], x["stop"], x["value"]) for x in r["found"] if x["kind"] == 3] == want
    own = spark.createDataFrame([(key(40), 1), ("the_word_of_the_user", 0), ("é", 1), (None, 0)], "s string, secret int")
    assert secrets.scan(docs, labels, sample=own).count() == len(texts)


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def check_licenses(rows, texts):
    for r in rows:
        w = words_of(texts[r["doc_id"]])
        at = [(i, label) for p, label in licenses.BASE for q in [p.split()] for i in range(len(w)) if w[i:i + len(q)] == q]
        starts = [i for i, _ in at]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(w), len(at), min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


def test_license_scan(documents, doc_rows, docs_df):
    check_licenses(licenses.scan(documents).collect(), dict(doc_rows))
    rows = [(1, None), (2, ""), (3, "CC BY cc-by, Cc By"), (4, "all rights reserved all rights all rights reserved"),
            (5, "general public general public license"), (6, "by cc"), (7, "the software " * 20000 + "CC BY"),
            (8, "x licensed under the Apache-License, version 2.0 y"), (9, "é cc by é"),
            (10, "Permission is hereby granted, free of charge, to any individual obtaining a copy of this software and "
                 "associated documentation files, to deal in the Software without any restriction"),
            (11, "permission is granted to any person")]
    out = {r["doc_id"]: r for r in licenses.scan(docs_df(rows)).collect()}
    check_licenses(out.values(), dict(rows))
    assert out[8]["labels"] == "apache-2.0" and out[10]["labels"] == "mit" and out[11]["labels"] == ""
    assert out[1]["score"] == 0 and out[3]["score"] == 1
    assert licenses.scan(docs_df([])).count() == 0


def test_automaton_matching_statistics():
    rng = random.Random(5)
    texts = [[rng.randrange(4) for _ in range(rng.randrange(1, 30))] for _ in range(6)]
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    auto = licenses.Automaton(texts)
    query = [rng.randrange(5) for _ in range(400)]
    for i, (state, length) in enumerate(auto.stream(query)):
        best = max((n for n in range(i + 2) if n == 0 or tuple(query[i + 1 - n:i + 1]) in runs), default=0)
        assert length == best
        for t, end in auto.ends[state] if length else ():
            assert texts[t][end - length + 1:end + 1] == query[i + 1 - length:i + 1]
