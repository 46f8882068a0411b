"""Operator 5: main text of web pages by wrapper induction per host.

 1. Every page is parsed into a tree (a forgiving parser: void and
    unclosed elements, optional end tags). Subtrees that hold no article
    text by their element, role or class (menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles, comments) are
    cut; inside an ``article`` or ``main`` element a header or an aside
    is judged the same way, and the article's own headings stay.
 2. The block elements of the content root (article or main where there is
    one, else body) are folded: siblings of one label become one
    repeating node, and siblings stand in label order. Simple tree
    matching looks for the largest order-preserving mapping of equal
    labels from the root down; on folded trees that mapping takes every
    pair of nodes with equal paths of labels, so two pages are aligned by
    comparing paths, in linear time and without recursion.
 3. The wrapper of a host and layout (the path down to the content root) is
    the union of its pages' aligned trees, made from all pages by counting:
    a node is its path. A text that stands under one node on more than
    ``SHARE`` of the different pages, and on two at least (one page has
    nothing to be compared with), is constant: template. What varies is a
    slot: content. Copies of a page count once.
 4. A page's text is its blocks that are no template. Where template would
    be more than ``SHARE`` of a page's text, its pages are near copies of
    one another rather than fillings of one template, and it keeps all.

Pages are never gathered and no wrapper is sent around: the counts are
map-side-combined aggregates of (host, layout, node, text), and only
constant texts are joined back. Each page is parsed once. All pages count;
nothing is sampled, and neither depth, length nor number of blocks has a
bound.

Defined results: null and empty html give empty text; html without any
element is one block of text; a null url is a host of its own; repeated
pages count as pages; extra columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import common as C
from cohortloom.llm.urls import host as url_host

SHARE = 0.8
LEAST_PAGES = 2      # by definition: what is constant stands on two pages

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre "
                  "section summary table tbody td tfoot th thead tr ul".split())
#: Elements that never hold article text.
CUT = frozenset("aside audio button canvas datalist dialog embed footer form head header iframe input label map math menu meta "
                "nav noframes noscript object script select style svg template textarea title video".split())
CUT_ROLE = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
CUT_NAME = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|adv|advert|advertisement|advertising|banner|breadcrumbs?|comments?|comment-list|consent|cookies?|disqus|"
    r"footer|gdpr|header|masthead|menu|nav|navbar|navigation|newsletter|notice|pagination|popup|promo|promoted|related|remark|replies|"
    r"respond|share|sharing|sidebar|site-info|social|sponsor|sponsored|subscribe|toolbar|widget)s?(?=$|[-_\s])", re.I)
#: An open element of the key is closed by a start tag of the values.
_P_ENDS = BLOCK - {"html", "body", "caption", "option", "optgroup", "legend", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt"}
_SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot", "thead"},
         "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}}
_CLOSED_BY = {tag: {k for k, v in _SAME.items() if tag in v} for tag in _SAME}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "option": {"select", "datalist"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'>/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")


class Node:
    """Element with children (nodes and strings); ``inside``: it is an
    article or main element or stands in one."""

    __slots__ = ("tag", "name", "kids", "inside")

    def __init__(self, tag: str, name: str = "", inside: bool = False):
        self.tag, self.name, self.kids = tag, name, []
        self.inside = inside or tag in ("article", "main")


#: Names of nodes whose subtree is cut, or holds nothing but headings.
CUT_ALL, HEADINGS = "\0", "\1"


def _name(tag: str, attrs: str, inside: bool) -> str:
    """Class and id of an element, or how it is cut. A header inside an
    article keeps its headings."""
    if tag in CUT:
        return HEADINGS if tag == "header" and inside else CUT_ALL
    if not attrs.strip():
        return ""
    values = {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTR.findall(attrs)}
    name = f"{values.get('class', '')} {values.get('id', '')}".strip()
    hidden = values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
    if hidden or values.get("role", "").lower() in CUT_ROLE:
        return CUT_ALL
    found = CUT_NAME.search(name) if tag not in ("html", "body", "main", "article") else None
    if found:
        return HEADINGS if inside and found[0].strip("-_ ").lower() == "header" else CUT_ALL
    return name


def parse(text: str) -> Node:
    """Tree of a page without the subtrees that hold no article text."""
    root = Node("#root")
    stack, at = [root], 0
    opened = Counter()      # open elements by tag

    def close(depth: int) -> None:
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    if not text:
        return root
    for m in _TOKEN.finditer(text):
        if m.start() < at:
            continue
        if m.start() > at:
            stack[-1].kids.append(text[at:m.start()])
        closing, tag = m[1], (m[2] or "").lower()
        at = m.end()
        if not tag:
            continue
        if closing:
            # an inline end tag does not close blocks opened after it
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break
            continue
        attrs = m[3] or ""
        name = _name(tag, attrs, stack[-1].inside)
        if tag in _P_ENDS and opened["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        elif tag in _SAME and any(opened[t] for t in _CLOSED_BY[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if tag in _SAME.get(stack[i].tag, ()):
                    close(i)
                    break
                if stack[i].tag in _SCOPE[tag]:
                    break
        node = Node(tag, name, stack[-1].inside)
        stack[-1].kids.append(node)
        if tag in RAW and not attrs.rstrip().endswith("/"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            node.kids.append(text[at:end.start() if end else len(text)])
            at = end.end() if end else len(text)
        elif tag not in VOID and not attrs.rstrip().endswith("/"):
            stack.append(node)
            opened[tag] += 1
    if at < len(text):
        stack[-1].kids.append(text[at:])
    return root


def _dropped(node: Node) -> bool:
    return node.name == CUT_ALL


def content_root(root: Node) -> Node:
    """The article or main element with the most text, else the body."""
    best = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if _dropped(node):
            continue
        if node.tag in ("article", "main", "body") and node.tag not in best:
            best[node.tag] = []
        if node.tag in best:
            best[node.tag].append(node)
        stack.extend(k for k in reversed(node.kids) if isinstance(k, Node))
    if "article" in best:
        outer = best["article"]
        if len(outer) == 1:
            return outer[0]
        joined = Node("article")
        inner = {id(k) for n in outer for k in _below(n)}
        joined.kids = [n for n in outer if id(n) not in inner]
        return joined
    for tag in ("main", "body"):
        if tag in best:
            return best[tag][0]
    return root


def _below(node: Node):
    stack = [k for k in node.kids if isinstance(k, Node)]
    while stack:
        n = stack.pop()
        yield n
        stack.extend(k for k in n.kids if isinstance(k, Node))


_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())


_OUTER = frozenset("html body main article".split())
_DIGITS = re.compile(r"\d+")


class Path:
    """Block element with those above it, as a chain. ``key`` is a hash of
    the labels down to it: the node of the folded tree."""

    __slots__ = ("key", "muted", "heading")

    def __init__(self, node: Node, up: Path | None):
        # names of the outermost elements and numbers in names tell pages apart, not places
        label = f"{node.tag}.{_DIGITS.sub('0', node.name)}" if node.name and node.tag not in _OUTER else node.tag
        self.key = hashlib.blake2b((up.key if up else b"") + label.encode("utf-8", "replace"), digest_size=8).digest()
        self.muted = node.name == HEADINGS or bool(up and up.muted)
        self.heading = node.tag in _HEADING or bool(up and up.heading)

    def number(self) -> int:
        return int.from_bytes(self.key, "big", signed=True)


class Block:
    """Text of one block with the path of block elements above it."""

    __slots__ = ("path", "parts")

    def __init__(self, path: Path | None):
        self.path, self.parts = path, []

    def text(self) -> str:
        if self.path and self.path.muted and not self.path.heading:
            return ""
        return " ".join("".join(map(entities.unescape, self.parts)).split())


def blocks(root: Node) -> list[Block]:
    """Non-empty text blocks in page order."""
    out, current = [], Block(None)
    work = [(root, None, False)]
    while work:
        node, path, leave = work.pop()
        if isinstance(node, str):
            current.parts.append(node)
            continue
        if leave:
            out.append(current)
            current = Block(path)
            continue
        if _dropped(node):
            if node.tag in BLOCK:
                out.append(current)
                current = Block(path)
            continue
        if node.tag == "br":
            current.parts.append(" ")
            continue
        inner = path
        if node.tag in BLOCK or node.tag == "#root":
            inner = Path(node, path)
            out.append(current)
            current = Block(inner)
            work.append((node, path, True))
        work.extend((k, inner, False) for k in reversed(node.kids))
    out.append(current)
    return [b for b in out if b.text()]


def layout(root: Node, content: Node) -> int:
    """Hash of the labels from the page's root to its content root."""
    work = [(root, None)]
    while work:
        node, up = work.pop()
        path = Path(node, up)
        if node is content or content.tag == node.tag != "#root" and node in content.kids:
            return path.number()
        work.extend((k, path) for k in reversed(node.kids) if isinstance(k, Node) and not _dropped(k))
    return 0


def _page(text: str) -> tuple[list[Block], int]:
    """Blocks of a page's content root and its layout."""
    root = parse(text)
    content = content_root(root)
    return blocks(content), layout(root, content)


def _align(batches):
    """page_id, url, host, layout, texts of the blocks and their nodes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            layouts, texts, nodes = [], [], []
            for text in part.column(3).to_pylist():
                found, kind = _page(text or "")
                layouts.append(kind)
                texts.append([b.text() for b in found])
                nodes.append([b.path.number() if b.path else 0 for b in found])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(layouts, pa.int64()), pa.array(texts, pa.list_(pa.string())), pa.array(nodes, pa.list_(pa.int64()))],
                names=["page_id", "url", "host", "layout", "texts", "nodes"])


def _strip(batches):
    """page_id, url, text without the constant texts of the page's group."""
    known: dict[int, frozenset] = {}
    for batch in batches:
        out = []
        for grp, texts, marks, fixed in zip(*(batch.column(i) for i in range(2, 6))):
            grp, texts, marks = grp.as_py(), texts.as_py(), marks.as_py()
            if grp not in known:
                if len(known) > 100:
                    known.clear()
                known[grp] = frozenset(fixed.as_py())
            free = [t for t, m in zip(texts, marks) if m not in known[grp]]
            near = sum(map(len, free)) < (1 - SHARE) * sum(map(len, texts))
            out.append("\n\n".join(texts if near else free))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars per page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        url_host(F.col(url_col).cast("string")).alias("host"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    aligned = C.saved(rows.mapInArrow(
        _align, f"page_id {kind}, url string, host string, layout long, texts array<string>, nodes array<long>"))
    marks = F.transform(F.arrays_zip("nodes", "texts"), lambda x: F.xxhash64(x["nodes"], x["texts"]))
    group = F.xxhash64("host", "layout")
    different = aligned.select(group.alias("grp"), F.xxhash64("texts", "nodes").alias("page"), marks.alias("marks")).distinct()
    total = different.groupBy("grp").agg(F.count("*").alias("pages"))
    stands = different.select("grp", F.explode(F.array_distinct("marks")).alias("mark"))
    fixed = (stands.groupBy("grp", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES).join(total, "grp")
             .where(F.col("n") > SHARE * F.col("pages")).groupBy("grp").agg(F.collect_list("mark").alias("fixed")))
    out = aligned.withColumn("grp", group).join(C.saved(fixed), "grp", "left")
    free = out.where("fixed is not null").select("page_id", "url", "grp", "texts", marks.alias("marks"), "fixed").mapInArrow(
        _strip, f"page_id {kind}, url string, text string")
    whole = out.where("fixed is null").select("page_id", "url", F.array_join("texts", "\n\n").alias("text"))
    return whole.union(free).withColumn("n_chars", F.length("text").cast("long"))
