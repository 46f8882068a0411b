"""Operators 4, 5, 8 and the pipeline."""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortloom.llm import decontam, html, queries, substrings


def text_of(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(4000)}" for _ in range(n))


def test_every_document_with_a_shared_passage_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    seen = defaultdict(set)
    for i, t in docs.collect():
        w = t.encode().split()
        for p in range(len(w) - 49):
            seen[tuple(w[p:p + 50])].add(i)
    truth = set().union(*(s for s in seen.values() if len(s) > 1))
    out = substrings.repeats(docs).collect()
    assert truth and truth <= {r["doc_id"] for r in out}
    assert all(r["removed"] == (r["doc_id"] != r["keeper"]) for r in out if r["kind"] == "passage")


def test_planted_passages_and_paragraphs(docs_df):
    rng = random.Random(2)
    passage, para = text_of(rng, 55), text_of(rng, 80).split()
    rows = [(i, text_of(rng, 300)) for i in range(60)]
    for i in range(0, 10):
        w = rows[i][1].split()
        k = rng.randrange(len(w))
        rows[i] = (i, " ".join(w[:k] + passage.split() + w[k:]))
    for i in range(20, 26):
        edited = list(para)
        edited[i] = f"edit{i}"
        rows[i] = (i, rows[i][1] + "\n" + " ".join(edited) + "\nshort line")
    rows += [(100, None), (101, ""), (None, passage), (102, "few words")]
    out = substrings.repeats(docs_df(rows)).collect()
    assert {r["doc_id"] for r in out} == {*range(10), *range(20, 26)}
    groups = defaultdict(list)
    for r in out:
        if r["kind"] == "paragraph":
            groups[r["cluster"]].append((r["doc_id"], r["removed"], r["keeper"]))
    assert [sorted(g) for g in groups.values()] == [[(20, False, 20)] + [(i, True, 20) for i in range(21, 26)]]
    assert substrings.repeats(docs_df([])).count() == 0


def left_over(rows, docs):
    """Words that stay when all removed passages are cut out."""
    cut = defaultdict(set)
    for r in rows:
        if r["kind"] == "passage" and r["removed"]:
            cut[r["doc_id"]] |= set(range(r["place"], r["place"] + r["n_words"]))
    return [w for i, t in docs for p, w in enumerate((t or "").split()) if p not in cut[i]]


def test_nested_and_overlapping_passages_lose_no_word(docs_df):
    rng = random.Random(5)
    w, x, y = ([f"{c}{k}" for k in range(n)] for c, n in (("w", 200), ("x", 300), ("y", 60)))
    own = lambda: text_of(rng, 40).split()
    parts = {1: w[:100], 5: w, 9: w, 10: x[:160], 11: x[80:240], 12: x[180:], 13: x, 20: y + own() + y, 21: y}
    docs = [(i, " ".join(own() + p + own())) for i, p in parts.items()]
    out = [r for r in substrings.repeats(docs_df(docs)).collect() if r["kind"] == "passage"]
    assert {v for _, t in docs for v in t.split()} - set(left_over(out, docs)) == set()
    first = {i: len(t.split()) - 40 - len(parts[i]) for i, t in docs}
    cut = {p - first[9] for r in out if r["doc_id"] == 9 for p in range(r["place"], r["place"] + r["n_words"]) if r["removed"]}
    assert set(range(20, 180)) <= cut <= set(range(200))
    kept = {(r["cluster"], r["doc_id"]) for r in out if not r["removed"]}
    assert all((r["cluster"], r["keeper"]) in kept for r in out)
    assert {r["keeper"] for r in out if r["doc_id"] == 9} == {1, 5}
    assert len({r["cluster"] for r in out if r["doc_id"] in (20, 21)}) == 1


def test_short_paragraphs_are_compared(docs_df):
    rng = random.Random(8)
    long, mid, five = text_of(rng, 52).split(), text_of(rng, 30).split(), text_of(rng, 5)
    lines = {1: long, 2: long[:49], 3: mid, 4: [*mid[:-1], "edit"], 5: five.split(), 6: five.upper().split(), 7: text_of(rng, 4).split()}
    docs = [(i, f"{text_of(rng, 20)}\n{' '.join(w)}\nshort line here") for i, w in lines.items()] + [(8, docs_line := " ".join(lines[7])), (9, docs_line)]
    out = [r for r in substrings.repeats(docs_df(docs)).collect() if r["kind"] == "paragraph"]
    groups = defaultdict(list)
    for r in out:
        groups[r["cluster"]].append((r["doc_id"], r["place"], r["n_words"], r["keeper"], r["removed"]))
    assert sorted(sorted(g) for g in groups.values()) == [
        [(1, 1, 52, 1, False), (2, 1, 49, 1, True)], [(3, 1, 30, 3, False), (4, 1, 30, 3, True)], [(5, 1, 5, 5, False), (6, 1, 5, 5, True)]]


def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment_equals_the_table():
    rng = random.Random(9)
    for _ in range(60):
        a = np.array([rng.randrange(5) for _ in range(rng.randrange(1, 20))], dtype=np.uint64)
        b = np.array([rng.randrange(5) for _ in range(rng.randrange(0, 30))], dtype=np.uint64)
        assert decontam.align(a, b)[0] == smith_waterman(a, b)


def test_leaks_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    words = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    items = {r["item_id"]: words(r["text"]) for r in bench.collect()}
    grams = defaultdict(set)
    for i, w in items.items():
        for p in range(len(w) - 2):
            grams[tuple(w[p:p + 3])].add(i)
    truth = set()
    for i, t in docs.select("doc_id", "text").collect():
        w = words(t)
        near = Counter(k for p in range(len(w) - 2) for k in grams.get(tuple(w[p:p + 3]), ()))
        truth |= {(i, k) for k, n in near.items() if n > 1 and smith_waterman(items[k], w) >= 2 * decontam.THRESHOLD * len(items[k])}
    assert truth and {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()} == truth


def test_edited_items_and_edges(spark, docs_df):
    rng = random.Random(11)
    items = [(i, text_of(rng, 30)) for i in range(20)] + [(50, "too short"), (51, None), (3, None), (None, text_of(rng, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, text_of(rng, 200)) for i in range(80)]
    for i in range(20):
        w = items[i][1].split()
        for p in rng.sample(range(30), 3):
            w[p] = "edited"
        del w[rng.randrange(len(w))]
        rows[i] = (i, rows[i][1] + " " + " ".join(w).upper() + " " + text_of(rng, 50))
    rows += [(200, None), (201, ""), (None, items[0][1]), (202, items[1][1]), (202, items[1][1])]
    df = docs_df(rows)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["item_id"]) for r in decontam.contaminated(df, bench).collect())
    assert got == sorted([(i, i) for i in range(20)] + [(-1, 0), (202, 1), (202, 1)])
    clean = decontam.keep_clean(df, bench)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted([*range(20, 80), 200, 201])
    assert decontam.contaminated(docs_df([]), bench).count() == 0
    assert decontam.contaminated(df, bench.limit(0)).count() == 0


def test_a_frequent_edited_copy_is_a_leak(spark, docs_df):
    rng = random.Random(21)
    item = [f"q{k}" for k in range(20)]
    edited = [f"z{k}" if k in (3, 7, 11, 15) else w for k, w in enumerate(item)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(0, f"{text_of(rng, 30)} {' '.join(item)} {text_of(rng, 30)}")]
    rows += [(i, f"{text_of(rng, 30)} {' '.join(edited)} {text_of(rng, 30)}") for i in range(1, 40)]
    rows += [(i, text_of(rng, 80)) for i in range(40, 50)]
    got = {r["doc_id"]: r["score"] for r in decontam.contaminated(docs_df(rows), bench).collect()}
    assert got == {0: 1.0} | dict.fromkeys(range(1, 40), 0.7)


def test_leaks_equal_alignment_of_whole_texts(spark, docs_df):
    rng = random.Random(33)
    say = lambda n, top=150: [f"v{rng.randrange(top)}" for _ in range(n)]
    items = {i: say(rng.choice([6, 7, 8, 12, 20, 31, 70, 140]), 4000) for i in range(40)}
    items |= {100 + n: [f"s{n}{k}" for k in range(n)] for n in range(1, 6)} | {110: []}
    rows = []
    for i in range(200):
        w = list(items[i % 40])
        for _ in range(rng.randrange(1 + len(w) // 2)):
            p = rng.randrange(len(w))
            w[p:p + 1] = rng.choice([["x"], [], [w[p], "y"]])
            w = w or ["x"]
        rows.append((i, say(rng.randrange(30), 4000) + w + say(rng.randrange(30), 4000)))
    third = [w if k % 3 != 2 else "x" for k, w in enumerate(items[next(i for i in range(40) if len(items[i]) == 20)])]
    spread = [v for w in items[next(i for i in range(40) if len(items[i]) == 12)] for v in (w, "y")]
    six, eight = (list(items[next(i for i in range(40) if len(items[i]) == n)]) for n in (6, 8))
    six[2] = eight[2] = eight[5] = "x"
    rows += [(300 + k, say(9) + w + say(9)) for k, w in enumerate((third, spread, six, eight))]
    for n in range(1, 6):
        rows += [(400 + n, say(5) + items[100 + n] + say(5)), (410 + n, items[100 + n]), (420 + n, items[100 + n][1:] + say(4)),
                 (430 + n, items[100 + n][:1] + ["x"] + items[100 + n][1:])]
    code = {}
    number = lambda ws: np.array([code.setdefault(w, len(code)) for w in ws], dtype=np.uint64)
    held = lambda a, b: any(b[p:p + len(a)] == a for p in range(len(b)))
    truth = {(d, i): decontam.align(number(a), number(b))[0] / (2 * len(a)) for i, a in items.items() if a for d, b in rows
             if (held(a, b) if len(a) < decontam.MIN_ITEM else decontam.align(number(a), number(b))[0] >= 2 * decontam.THRESHOLD * len(a))}
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.contaminated(docs_df([(d, " ".join(w)) for d, w in rows]), bench).collect()}
    assert {300, 301, 302, 303} <= {d for d, _ in truth}
    assert got == truth


def article(page):
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", m[1]) if m else []
    texts = (" ".join(entities.unescape(re.sub(r"</?(?:b|br)>", "", p)).split()) for p in parts)
    return "\n\n".join(t for t in texts if t)


def test_page_text_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    for r in html.main_text(pages).collect():
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


PAGE = ("<html><body><div class='top-menu'>Menu</div><div><div>Site name and motto</div><section><h2>Title {0}</h2><p>First {0} &amp; <i>more</i>\n"
        "text<p>Second&nbsp;{0}</section><div id=comments><p>Reader {0}</p></div><div>Same closing line</div></div>"
        "<script>if (a < b) x = '<p>no</p>'</script><form><p>Mail</p></form></body></html>")


def test_constant_nodes_are_template(spark):
    rows = [(i, "http://h.org/a", PAGE.format(i)) for i in range(30)] + [(100, "http://lone.org/", PAGE.format("x"))]
    copies = [(200 + i, "http://copy.org/", PAGE.format("same")) for i in range(30)]
    out = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows + copies, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert out[i] == f"Title {i}\n\nFirst {i} & more text\n\nSecond {i}"
    assert out[100] == "Site name and motto\n\nTitle x\n\nFirst x & more text\n\nSecond x\n\nSame closing line"
    assert "First same" in out[200]                      # copies are not template


def test_the_share_of_template_pages_is_exact(spark):
    page = "<html><body><section><p>Text {0}</p></section><div>{1}</div></body></html>"
    rows = [(1000 * h + i, f"http://h{h}.org/", page.format(i, "Closing line" if i < 320 + h % 2 else f"Other {i}"))
            for h in range(12) for i in range(400)]
    out = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    left = Counter(r["page_id"] // 1000 for r in out if "Closing line" in r["text"])
    assert left == {h: 320 for h in range(0, 12, 2)}


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b</b>c", "a\n\nbc"),
    ("<main><h1>T</h1>x<br>y</main><p>out</p>", "T\n\nx y"), ("<article><header><h1>T</h1><p>by me</p></header><p>x</p><aside>no</aside></article>", "T\n\nx"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"), ("<p>&lt;p&gt; &#233;&eacute; &amp", "<p> éé &"),
    ("<p>1 < 2 > 0</p><!-- <p>no</p> --><style>p{}</style>z", "1 < 2 > 0\n\nz"), ("<div class='ad'>no</div><div class='shadow'>yes</div>", "yes"),
    ("<article><p>a</p></article><article><p>b</p></article>", "a\n\nb"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
])
def test_page_forms(page, text):
    assert "\n\n".join(b.text() for b in html._page(page or "")[0]) == text


def tree_match(a, b):
    """Matched pairs of paths by simple tree matching of (label, children)."""
    x, y = a[1], b[1]
    best = [[[]] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            sub = [(x[i][0], *p) for p in tree_match(x[i], y[j])] if x[i][0] == y[j][0] else []
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + sub, key=len)
    return [()] + best[-1][-1]


def folded(paths):
    """Tree with siblings of one label as one, in label order, from paths."""
    kids = {}
    for p in paths:
        if p:
            kids.setdefault(p[0], []).append(p[1:])
    return sorted((label, folded(below)) for label, below in kids.items())


def test_equal_paths_are_the_largest_match_of_folded_trees():
    rng = random.Random(6)
    for _ in range(200):
        one, two = ({tuple(rng.choice("pdu") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 9))} for _ in range(2))
        whole = [{p[:k] for p in paths for k in range(len(p) + 1)} for paths in (one, two)]
        assert set(tree_match(("", folded(one)), ("", folded(two)))) == whole[0] & whole[1]
    # the keys of blocks are such paths: equal where tags and classes are, whatever the siblings and numbers
    key = lambda page, k=-1: html._page(page)[0][k].path.key
    assert key("<div class='c7'><p>a</div>") == key("<h1>t</h1><div class='c12'><p>x</p><p>y</p></div>")
    assert key("<div class='c'><p>a</div>") != key("<div class='d'><p>a</div>") != key("<div class='d'>a</div>")


def run_pages(spark, rows):
    return {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_template_does_not_depend_on_the_number_of_pages(spark):
    body = "<body><section><h2>Title {0}</h2><p>First {0} words</p></section><div>Closing line</div></body>"
    rows = [(100 * n + i, f"http://h{n}.org/", body.format(i)) for n in (2, 3, 7, 8, 30) for i in range(n)]
    out = run_pages(spark, rows + [(1, "http://one.org/", body.format(1))])
    assert out.pop(1) == "Title 1\n\nFirst 1 words\n\nClosing line"
    assert out == {p: f"Title {p % 100}\n\nFirst {p % 100} words" for p in out} and len(out) == 50


def test_each_layout_of_a_host_has_its_template(spark):
    page = "<body><div class='{1}'><main><p>Text {0}</p><p>Line of {1}</p></main></div></body>"
    out = run_pages(spark, [(i, "http://h.org/", page.format(i, "ab"[i % 2] * 3)) for i in range(20)])
    assert out == {i: f"Text {i}" for i in range(20)}


def test_near_copies_of_a_page_keep_their_text(spark):
    page = "<body><main><p>" + "</p><p>".join(f"Line {k} of an article" for k in range(9)) + "</p><p>Edit {0}</p></main></body>"
    out = run_pages(spark, [(i, "http://h.org/", page.format(i)) for i in range(4)])
    assert out == {i: "\n\n".join([f"Line {k} of an article" for k in range(9)] + [f"Edit {i}"]) for i in range(4)}


def test_deep_and_long_pages(spark):
    deep = "<article>" + "<div>" * 20000 + "deep {0}" + "</div>" * 20000 + "<p>Closing</p>"
    mixed = "<article>" + "".join(f"<h2>h{k}</h2><p class='x{k}'>text {k} {{0}}</p></b>" for k in range(20000)) + "<div>Closing</div>"
    out = run_pages(spark, [(2 * i + k, f"http://h{k}.org/", page.format(i)) for k, page in enumerate((deep, mixed)) for i in range(3)])
    for i in range(3):
        assert out[2 * i] == f"deep {i}"
        assert out[2 * i + 1].endswith(f"text 19999 {i}") and f"text 7 {i}\n\n" in out[2 * i + 1]


def test_page_edges(spark):
    schema = "page_id long, url string, html string, text string, host int"
    rows = [(1, None, None, "x", 1), (2, "http://a/", "", "x", 1), (None, "u", "<p>a", "x", 1), (2, "http://a/", "", "x", 1)]
    out = html.main_text(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(
        map(str, [(1, None, "", 0), (2, "http://a/", "", 0), (None, "u", "a", 1), (2, "http://a/", "", 0)]))
    assert html.main_text(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_stages_and_run(spark):
    import corpus_pipeline as P
    from cohortloom.llm.common import saved

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    for name, stage in P.STAGES:
        out = saved(stage(spark, docs, sf))
        if name != "sharding":
            assert out.columns == docs.columns and out.join(docs, "doc_id", "left_anti").count() == 0
        docs = out
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5]
    assert sorted(map(str, P.run(spark, sf).collect())) == sorted(map(str, docs.collect()))
    assert P.ORACLE_SQL is None and "pipeline" in queries.QUERIES
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_a_repeated_row_is_one_document(docs_df):
    rng = random.Random(12)
    text, other = text_of(rng, 70), text_of(rng, 70)
    assert substrings.repeats(docs_df([(1, text), (1, text), (2, other)])).count() == 0
    out = substrings.repeats(docs_df([(1, text), (1, text), (3, text), (2, other), (1, other)])).collect()
    assert sorted((r["doc_id"], r["keeper"]) for r in out if r["kind"] == "paragraph") == [(1, 1), (1, 1), (2, 1), (3, 1)]
