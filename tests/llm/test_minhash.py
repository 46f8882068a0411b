from __future__ import annotations

import random
from collections import Counter

from cohortloom.llm import common as C
from cohortloom.llm import minhash


def sets_of(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, percent=80):
    """{id: (set size, least id of the component)} from all pairs that share a shingle."""
    sets = {i: sets_of(t, k) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    seen = {}
    for i in sorted(sets):
        common = Counter(j for s in sets[i] for j in seen.get(s, ()))
        for s in sets[i]:
            seen.setdefault(s, []).append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(sets[i]), top(i)) for i in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_components_equal_brute_force(documents, doc_rows):
    for k in (2, 5):
        got = minhash.near_dups(documents, shingle=k)
        assert result(got) == brute(doc_rows, k)


def near_group(n, words, seed):
    """Chains of edits: neighbours are near copies, the ends are not."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        out.append((i * 3 + seed, " ".join(text)))
        text[(i * 7) % words] = f"e{i}"
    return out


def test_chain_of_edits_and_copies(docs_df):
    rows = near_group(60, 40, 1) + near_group(50, 120, 2)
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    got = minhash.near_dups(docs_df(rows), shingle=2)
    assert result(got) == brute(rows, 2)
    assert all((r["doc_id"] == r["component_id"]) == r["kept"] for r in got.collect())


def test_outsiders_link_to_members_of_a_large_group(docs_df):
    """A centre with 40 one-word edits of it; outsiders are near copies of
    one edit each but not of the centre, and some texts are near none."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    rows = [(500, " ".join(base))]
    for i in range(40):
        copy = list(base)
        copy[2 * i] = f"c{i}"
        rows.append((501 + i, " ".join(copy)))
        for more, first in ((5, 100), (5, 200), (9, 300)):
            if i < 12:
                other = list(copy)
                for at in rng.sample([x for x in range(1, 99, 3) if abs(x - 2 * i) > 1], more):
                    other[at] = f"o{first + i}x{at}"
                rows.append((first + i, " ".join(other)))
    want = brute(rows, 2)
    assert len({c for _, c in want.values()}) > 1            # the far ones stand alone
    assert want[500][1] == want[100][1] == 100                # outsiders joined the group through its members
    assert result(minhash.near_dups(docs_df(rows), shingle=2)) == want


def test_edges(docs_df):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "ONE"), (3, "a b"), (4, "a  b"), (10, "café É"), (11, "café é"),
            (12, "x" * 50000), (None, "a b"), (3, "a b")]
    got = [tuple(r) for r in minhash.near_dups(docs_df(rows), shingle=2).collect()]
    assert len(got) == len(rows)
    by = {r[0]: r[1:] for r in got if r[0] is not None}
    assert by[5] == by[6][:0] + (0, 5, True) and by[6] == (0, 6, True) and by[7] == (0, 7, True)
    assert by[8] == (1, 8, True) and by[9] == (1, 8, False)
    assert by[3] == (1, 3, True) and by[4] == (1, 3, False)
    assert by[10][1] == 10 and by[11][1] == 11          # only ASCII letters are lower-cased
    assert (None, 1, None, True) in got
    assert minhash.near_dups(docs_df([]), shingle=2).count() == 0


def test_drop_copies_keeps_one_row_of_a_group_and_all_columns(docs_df):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(4, base), (2, base), (2, base), (9, base + " tail"), (5, "other text that stands alone here"), (None, None), (6, None)]
    df = docs_df(rows)
    out = minhash.drop_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == sorted(
        [(2, base), (5, rows[4][1]), (0, None), (6, None)], key=lambda x: (x[0], x[1] or ""))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in C.components(df).distinct().collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert C.components(df.limit(0)).count() == 0
