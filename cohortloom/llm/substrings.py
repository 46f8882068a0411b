"""Operator 4: repeated paragraphs and passages.

Two kinds of unit are compared.

* Paragraphs: ``\\n``-separated lines of ``SHINGLE`` words or more, as
  sets of five-word shingles. MinHash with 16 bands of four minima finds
  colliding paragraphs (a pair of similarity 0.8 is missed with
  probability 2e-4), the pairs are confirmed by exact Jaccard similarity
  of 0.8 or more, and components of the confirmed links are the clusters.
* Anchored passages: a passage copied into the middle of other text has no
  paragraph of its own, so windows of ``WINDOW`` words are hashed, and the
  least hash of every ``ANCHORS`` consecutive windows is an anchor. Any
  passage of ``WINDOW + ANCHORS - 1`` = 50 or more words that two
  documents share has a common anchor. Windows with equal hashes are equal
  texts (Jaccard 1). The keeper of a window is the first document that
  holds it; touching windows of a document are joined into one passage as
  long as they lie in one passage of the same keeper. Passages of keepers
  that share a window (a text that repeats in its keeper) are one cluster,
  found as components.

Within a paragraph cluster the unit that comes first (least doc_id, then
place) is kept, all others are removals. A passage is removed unless its
document is its keeper. What is removed always stands in an earlier
document, so by descent every removed word stands in one that is kept,
whether passages nest, overlap or have several keepers. Equal units are one row in candidate search
whatever their number; anchors are counted before they are joined back, so
a passage that a third of all documents share is never gathered.

Defined results: null texts and lines under five words have no units; only units with a
partner in another document, or paragraphs repeated in their own, give
rows; a null id takes no part; rows that share an id and a text are one
document; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm import common as C
from cohortloom.llm.minhash import KEY_BITS, links

SHINGLE = 5
WINDOW, ANCHORS = 32, 19
BANDS = 16


def _anchors(batches):
    """doc_id, mark (window hash), first word of the chosen windows."""
    for batch in batches:
        data, off = C.text_bytes(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, b in C.row_chunks(off):
            _, _, h, woff = C.words(data[off[a]:off[b]], off[a:b + 1] - off[a], C.SPACE_WORDS)
            n = len(h)
            if n < WINDOW:
                continue
            p, inv = C._power(n + 1)
            c = np.zeros(n + 1, np.uint64)
            np.cumsum(h * p[:n], out=c[1:])
            w = C.mix((c[WINDOW:] - c[:-WINDOW]) * inv[:n - WINDOW + 1])
            chosen, row = [], []
            for r in range(b - a):
                lo, hi = int(woff[r]), int(woff[r + 1]) - WINDOW + 1
                if hi <= lo:
                    continue
                own = w[lo:hi]
                k = min(ANCHORS, len(own))
                least = np.lib.stride_tricks.sliding_window_view(own, k).argmin(axis=1) + np.arange(len(own) - k + 1)
                least = np.unique(least)
                chosen.append(least + lo)
                row.append(np.full(len(least), r))
            if not chosen:
                continue
            at, row = np.concatenate(chosen), np.concatenate(row)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[a + row].astype(np.int64)), pa.array(w[at].view(np.int64)), pa.array((at - woff[row]).astype(np.int32)),
            ], names=["doc_id", "mark", "place"])


def _runs(rows: DataFrame, *part: str) -> DataFrame:
    """``rows`` with the first place of the run of touching windows they are in."""
    order = Window.partitionBy(*part).orderBy("place", "mark")
    before = F.coalesce(F.lag("place").over(order), F.lit(-2 * WINDOW))
    rows = rows.withColumn("start", F.when(F.col("place") > before + WINDOW, F.col("place")))
    return rows.withColumn("start", F.max("start").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def passages(read: DataFrame) -> DataFrame:
    """Repeated passages: doc_id, place (first word), n_words, cluster, keeper, removed."""
    marks = C.saved(read.mapInArrow(_anchors, "doc_id long, mark long, place int"))
    shared = (marks.groupBy("mark").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
              .where("keeper <> last").drop("last"))
    own = C.saved(_runs(marks.join(shared.withColumnRenamed("keeper", "doc_id"), ["mark", "doc_id"]), "doc_id"))
    # a window's home is its first run in its keeper; homes that share a window are one cluster
    run = F.struct("doc_id", "start")
    home = own.groupBy("mark").agg(F.min(run).alias("home"))
    root = C.components(own.join(home, "mark").select(run.alias("a"), F.col("home").alias("b")))
    home = C.saved(home.join(root.withColumnRenamed("node", "home"), "home", "left")
                   .select("mark", "home", F.xxhash64(F.coalesce("root", "home")).alias("cluster")))
    # the windows of other documents fall into runs of one home each, so a run has one keeper
    held = _runs(marks.join(home, "mark").where(F.col("doc_id") != F.col("home.doc_id")), "doc_id", "home")
    rows = (held.select("doc_id", "home", "start", "place", "cluster")
            .union(own.join(home.select("mark", "cluster"), "mark").select("doc_id", run.alias("home"), "start", "place", "cluster")))
    return (rows.groupBy("doc_id", "home", "start").agg((F.max("place") - F.col("start") + WINDOW).alias("n_words"), F.min("cluster").alias("cluster"))
            .select("doc_id", F.col("start").alias("place"), "n_words", "cluster", F.col("home.doc_id").alias("keeper"),
                    (F.col("doc_id") != F.col("home.doc_id")).alias("removed")))


def paragraphs(read: DataFrame) -> DataFrame:
    """Near-equal paragraphs: doc_id, place (line number), n_words, cluster, keeper, removed."""
    def lines(texts: DataFrame) -> DataFrame:
        return (texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("place", "text"))
                .where(F.length("text") >= 2 * SHINGLE - 1).select(F.struct("doc_id", "place").alias("unit"), "text"))

    def rows_of(ids: DataFrame) -> DataFrame:
        """Lines of the documents that have some of the units."""
        own = C.filter_words(ids.select(F.xxhash64("doc_id.doc_id").alias("tag")), "tag", KEY_BITS)
        return lines(C.passing(read.withColumn("tag", F.xxhash64("doc_id")), "tag", own, KEY_BITS))

    placed, classes, edges = links(lines(read), "unit", "text", SHINGLE, 80, BANDS, whole=False, rows_of=rows_of)
    placed = placed.where("cls is not null")
    root = C.components(edges)
    home = (classes.join(root.withColumnRenamed("node", "cls"), "cls", "left")
            .select("cls", F.coalesce("root", "cls").alias("root"), F.col("doc_id").alias("head")))
    rows = placed.join(home, "cls")
    groups = (home.groupBy("root").agg(F.min("head").alias("head"))
              .join(rows.groupBy("root").agg(F.count("*").alias("n")).where("n > 1"), "root").drop("n"))
    return (rows.drop("head").join(groups, "root")
            .select("doc_id.doc_id", "doc_id.place", F.col("n_words").cast("int").alias("n_words"),
                    F.xxhash64("root").alias("cluster"), F.col("head.doc_id").alias("keeper"), (F.col("doc_id") != F.col("head")).alias("removed")))


def _once(read: DataFrame) -> DataFrame:
    """Rows that share an id and a text as one row. Only rows of an id that
    occurs more than once are dealt by (id, digest of the text); they are
    found by counting ids alone, through a filter of fixed size."""
    tag = F.xxhash64("doc_id").alias("tag")
    twice = read.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(tag)
    words = C.filter_words(twice, "tag", KEY_BITS)
    if words.isEmpty():
        return read
    low = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    marked = read.withColumn("_low", low).join(F.broadcast(words), F.shiftright("_low", 6) == F.col("word"), "left")
    again = F.coalesce(F.expr("(shiftright(set, cast(_low & 63 as int)) & 1) = 1"), F.lit(False))
    marked = C.saved(marked.select("doc_id", "text", again.alias("again")))
    few = marked.where("again").groupBy("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).agg(F.first("text").alias("text"))
    return marked.where("not again").select("doc_id", "text").union(few.select("doc_id", "text"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kind (paragraph or passage), place, n_words, cluster,
    keeper (doc_id of the unit that stays), removed."""
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    read = _once(read)
    one = paragraphs(read).select("doc_id", F.lit("paragraph").alias("kind"), "place", "n_words", "cluster", "keeper", "removed")
    two = passages(read).select("doc_id", F.lit("passage").alias("kind"), "place", "n_words", "cluster", "keeper", "removed")
    return one.union(two)
