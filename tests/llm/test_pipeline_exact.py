"""The pipeline's stages against brute force on a small fixture."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline as P
import pytest
from cohortloom.llm.common import saved

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def say(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def documents():
    """(doc_id, text): plain, short and repetitive texts, chains of near
    copies, edited too far, exact copies, held items, nulls, repeated rows."""
    rng = random.Random(17)
    item = say(rng, 20)
    rows = []
    for i in range(30):
        text = say(rng, rng.randrange(60, 140))
        rows.append((10 * i, " ".join(text)))
        if i % 3 == 0:                                   # a chain of edits: neighbours are near, its ends need not be
            for k in range(1, 4):
                text = list(text)
                text[10 * k + 5] = f"edit{i}.{k}"
                rows.append((10 * i + k, " ".join(text)))
        if i % 5 == 0:
            rows.append((10 * i + 7, " ".join(text)))
        if i % 4 == 1:
            rows.append((10 * i + 8, " ".join(text[:20] + item + text[20:])))
    rows += [(1000 + n, " ".join(say(rng, n))) for n in (0, 1, 49, 50)] + [(1100, " ".join(say(rng, 9) * 12)), (1200, None), (1201, "")]
    rows += [(None, " ".join(say(rng, 70))), (1300, rows[0][1] + " tail"), (1301, " ".join(say(rng, 5000)))]
    return rows + [rows[4], rows[-1]], " ".join(item)


def good(text):
    w = WORDS.findall(text or "")
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(3)}
    return len(w) >= 50 and 100 * len(repeated) <= 50 * len(w)


def first_of_groups(rows):
    """One row per component of the links between all pairs."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0]))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (WORDS.findall(t) for _, t in rows)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [r for i, r in enumerate(rows) if find(i) == i]


@pytest.fixture()
def sf(spark, tmp_path):
    """A folder of tables with an empty labels table."""
    rows, item = documents()
    table = [(i, t, "en", "abc"[k % 3] if k % 7 else None, len(t or ""), k, "x") for k, (i, t) in enumerate(rows)]
    # a repeated row is equal in all columns
    table[-2], table[-1] = table[4], table[-3]
    frame = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, row int, item_id string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, item


def test_stages_equal_brute_force(spark, sf):
    folder, rows, item = sf
    stages = dict(P.STAGES)
    key = lambda r: (r[0] is None, r)
    listed = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=key)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    docs = saved(stages["quality rules"](spark, docs, folder))
    want = sorted((r for r in rows if good(r[1])), key=key)
    assert listed(docs) == want and docs.columns == P.COLUMNS

    docs = saved(stages["near dedup"](spark, docs, folder))
    kept = first_of_groups(want)
    assert len(kept) < len(set(want)) and listed(docs) == sorted(kept, key=key)

    docs = saved(stages["decontamination"](spark, docs, folder))
    clean = [r for r in kept if f" {item} " not in f" {r[1]} "]
    assert len(clean) < len(kept) and listed(docs) == sorted(clean, key=key)

    mixed = saved(stages["mixing"](spark, docs, folder))
    copies = Counter(listed(mixed))
    assert set(copies) <= set(clean) and max(copies.values()) <= 2

    out = stages["sharding"](spark, mixed, folder).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(i for i, _ in listed(mixed))
