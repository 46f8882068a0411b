"""Operator 8: benchmark decontamination by gapped seeds and alignment.

 1. Seeds of a test item are its word pairs one or two places apart, so
    that a replaced, added or left out word between two equal ones does no
    harm; an item of fewer than ``MIN_ITEM`` words has its whole word
    sequence as one seed. An alignment of m matches and e errors scores
    2m - e, so from ``THRESHOLD`` t on an item of n words at least
    m - 1 - e/2 >= tn - 1 neighbouring matches have at most one error
    between them. Each of them is a seed, and their diagonals are at most
    e <= 2n(1 - t) apart.
 2. Rare seeds: of the tn - 1 places a match needs, fewer than half may go.
    So many of an item's places, those whose seeds the most items share,
    are left out, and the number needed falls by as many. Whatever is left
    out, a match keeps that number, so nothing above the threshold is lost.
    How often texts hold a seed plays no part: a leak stays one however
    frequent it is.
 3. Texts are read once; their pairs pass a filter of fixed size and join
    the rare seeds. Hits are counted per text, item and stretch of
    diagonals; stretches with enough different places are candidates.
    Their texts are read again, cut into overlapping pieces of words, and
    met by the candidates of the piece, so neither a text nor the
    benchmark is gathered anywhere.
 4. Smith-Waterman local alignment of item and window (match 2, mismatch
    and gap -1) scores it: score / (2 x item words). From ``THRESHOLD`` the
    text holds the item, as it is, edited or paraphrased in part; a short
    item is held as it is only.

A text's leaks are keyed by its digest and joined back to all documents
that have it.

Defined results: words are runs of ASCII letters and digits and of any
other non-ASCII characters, after lower-casing; null and empty texts hold nothing; items without words are
in no text; an item listed twice counts once; a null id is reported as null; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm import common as C

MIN_ITEM = 6
PAIRS = ((0, 1), (0, 2))
THRESHOLD = 0.5
#: Bits of the filters of seeds (2 MB) and of texts.
FILTER_BITS = 24
#: Least number of words from one piece's start to the next.
PIECE = 4096
_MATCH, _MISS, _GAP = 2, -1, -1


def _word_rows(table):
    def run(batches):
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for a, b in C.row_chunks(off):
                _, _, h, woff = C.words(data[off[a]:off[b]], off[a:b + 1] - off[a], table)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a),
                    pa.array([h[woff[i]:woff[i + 1]].tobytes() for i in range(b - a)], pa.binary())], names=["item_id", "words"])
    return run


def _gram(h, steps, salt):
    """Hash of the words at ``steps`` from each place where they all exist."""
    n = max(len(h) - steps[-1], 0)
    out = np.full(n, salt, np.uint64)
    for j in steps:
        out = C.mix(out * np.uint64(0x2545F4914F6CDD1D) + h[j:j + n])
    return out


def _grams(h, short):
    """(seeds by place, last step) of the pairs and of the whole sequences of ``short`` words."""
    yield from ((_gram(h, steps, 0), steps[-1]) for steps in PAIRS)
    yield from ((_gram(h, range(k), k), k - 1) for k in short)


def _item_seeds(batches):
    """item, size, seed, place of the seeds of the items."""
    for batch in batches:
        rows = [(key, len(h), x) for key, w in zip(*(c.to_pylist() for c in batch.columns)) for h in [np.frombuffer(w, np.uint64)]
                for x in ([_gram(h, range(len(h)), len(h))] if len(h) < MIN_ITEM else [_gram(h, steps, 0) for steps in PAIRS])]
        spread = lambda values: np.repeat(np.array(values, np.int64), [len(x) for _, _, x in rows])
        if rows:
            yield pa.RecordBatch.from_arrays([
                pa.array(spread([k for k, _, _ in rows])), pa.array(spread([n for _, n, _ in rows]).astype(np.int32)),
                pa.array(np.concatenate([x for _, _, x in rows]).view(np.int64)),
                pa.array(np.concatenate([np.arange(len(x)) for _, _, x in rows]).astype(np.int32))], names=["item", "size", "seed", "place"])


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local alignment score, text place after its end)."""
    ramp = np.arange(len(text) + 1, dtype=np.int32) * -_GAP
    row = np.zeros(len(text) + 1, np.int32)
    best, end = 0, 0
    for word in item:
        new = np.zeros_like(row)
        np.maximum(row[:-1] + np.where(text == word, _MATCH, _MISS), row[1:] + _GAP, out=new[1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + ramp) - ramp
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def _text_seeds(bits, short):
    """text_key, seed, at of the seeds of texts that pass the filter."""
    def run(batches):
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for a, b in C.row_chunks(off):
                _, _, h, woff = C.words(data[off[a]:off[b]], off[a:b + 1] - off[a], C.PLAIN_WORDS)
                for s, reach in _grams(h, short):
                    at = np.flatnonzero(C.in_filter(bits, s))
                    row = np.searchsorted(woff, at, "right") - 1
                    on = at + reach < woff[row + 1]
                    at, row = at[on], row[on]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(a + row)), pa.array(s[at].view(np.int64)), pa.array((at - woff[row]).astype(np.int32))],
                        names=["text_key", "seed", "at"])
    return run


def _pieces(step, length):
    """text_key, piece, words: ``length`` words from every ``step``-th on."""
    def run(batches):
        for batch in batches:
            data, off = C.text_bytes(batch.column(1))
            for a, b in C.row_chunks(off):
                _, _, h, woff = C.words(data[off[a]:off[b]], off[a:b + 1] - off[a], C.PLAIN_WORDS)
                cut = [(r, k) for r in range(b - a) for k in range(-(-int(woff[r + 1] - woff[r]) // step))]
                for i in range(0, len(cut), 256):
                    part = cut[i:i + 256]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array([a + r for r, _ in part], pa.int64())), pa.array([k for _, k in part], pa.int32()),
                        pa.array([h[woff[r] + k * step:min(woff[r + 1], woff[r] + k * step + length)].tobytes() for r, k in part], pa.binary())],
                        names=["text_key", "piece", "words"])
    return run


def _align_rows(step):
    """text_key, item_id, score, last_word of the candidates that reach the threshold."""
    def run(batches):
        for batch in batches:
            out = []
            for key, piece, words, items in zip(*(c.to_pylist() for c in batch.columns)):
                text = np.frombuffer(words, np.uint64)
                for x in items:
                    item, first = np.frombuffer(x["words"], np.uint64), x["first"] - piece * step
                    score, end = align(item, text[first:first + x["length"]])
                    if score >= THRESHOLD * _MATCH * len(item):
                        out.append((key, x["item_id"], score / (_MATCH * float(len(item))), x["first"] + end))
            kinds = (("text_key", pa.binary()), ("item_id", pa.int64()), ("score", pa.float64()), ("last_word", pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])
    return run


def _rare(seeds: DataFrame) -> DataFrame:
    """The item's seeds without the places that most items share, and the
    number of places a match then holds at least."""
    whole = F.col("size") < MIN_ITEM
    need = F.when(whole, 1).otherwise(F.ceil(THRESHOLD * F.col("size")) - 1).cast("int")
    held = seeds.groupBy("seed").agg(F.count_distinct("item").alias("held"))
    places = seeds.join(held, "seed").groupBy("item", "place").agg(F.max("held").alias("held"), F.first("size").alias("size"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("held"), "place"))
    places = places.withColumn("need", need).withColumn("out", (F.col("held") > 1) & (rank <= F.floor((F.col("need") - 1) / 2)))
    left = F.col("need") - F.sum(F.col("out").cast("int")).over(Window.partitionBy("item"))
    places = places.withColumn("need", left.cast("int")).where("not out").select("item", "place", "need")
    return seeds.join(places, ["item", "place"])


def _text_key(col) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(col).cast("string"), F.lit(""))))


def leaks(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """text_key, item_id, score, last_word of every text that holds an item."""
    items = bench.select(F.col(item_col).cast("long").alias("item_id"), F.lower(F.col(item_text).cast("string")).alias("text")).where("item_id is not null").distinct()
    items = items.mapInArrow(_word_rows(C.PLAIN_WORDS), "item_id long, words binary").where(F.octet_length("words") > 0).distinct()
    items = C.saved(items.withColumn("item", F.xxhash64("item_id", "words")))
    texts = docs.select(_text_key(text_col).alias("text_key"), F.lower(F.col(text_col).cast("string")).alias("text")).where("text is not null")

    seeds = items.select("item", "words").mapInArrow(_item_seeds, "item long, size int, seed long, place int")
    seeds = C.saved(_rare(C.saved(seeds)))
    short = [r["size"] for r in seeds.where(F.col("size") < MIN_ITEM).select("size").distinct().collect()]  # MIN_ITEM - 1 at most
    bits = C.bit_filter(seeds, "seed", FILTER_BITS)
    hits = C.saved(texts.mapInArrow(_text_seeds(bits, sorted(short)), "text_key binary, seed long, at int"))

    drift = F.ceil(2 * (1 - THRESHOLD) * F.col("size")).cast("int")
    met = hits.join(seeds, "seed").select("text_key", "item", "size", "need", "place", (F.col("at") - F.col("place")).alias("d"), drift.alias("drift"))
    # two overlapping cuts of the diagonals, each twice as wide as a match may drift
    cut = F.floor(F.col("d") / F.col("drift"))
    met = met.withColumn("cut", F.explode(F.array(cut, cut - 1)))
    own = ["text_key", "item", "size", "need", "drift", "cut"]
    span = [F.min("low").alias("low"), F.max("high").alias("high")]
    near = met.groupBy(*own, "place").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    near = near.groupBy(*own).agg(F.count("*").alias("n"), *span).where("n >= need")
    # a window reaches as far to both sides as a match may drift
    wide = F.when(F.col("size") < MIN_ITEM, 0).otherwise(F.col("drift"))
    first = F.greatest(F.col("low") - wide, F.lit(0))
    near = near.select("text_key", "item", first.alias("first"), (F.col("high") + F.col("size") + wide - first).alias("length")).distinct()
    near = C.saved(near)

    over = near.agg(F.max("length")).first()[0] or 0
    step = max(PIECE, over)
    windows = near.join(items, "item").withColumn("piece", F.floor(F.col("first") / step).cast("int"))
    windows = windows.groupBy("text_key", "piece").agg(F.collect_list(F.struct("item_id", "words", "first", "length")).alias("items"))
    tag = F.xxhash64("text_key")
    some = C.filter_words(near.select(tag.alias("tag")), "tag", FILTER_BITS)
    some = C.passing(texts.withColumn("tag", tag), "tag", some, FILTER_BITS).select("text_key", "text")
    pieces = some.mapInArrow(_pieces(step, step + over), "text_key binary, piece int, words binary")
    pieces = pieces.join(windows.select("text_key", "piece"), ["text_key", "piece"], "left_semi").groupBy("text_key", "piece").agg(F.first("words").alias("words"))
    found = pieces.join(windows, ["text_key", "piece"]).mapInArrow(_align_rows(step), "text_key binary, item_id long, score double, last_word int")
    best = F.max(F.struct("score", "last_word"))
    return found.groupBy("text_key", "item_id").agg(best.alias("x")).select("text_key", "item_id", "x.score", "x.last_word")


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, score, last_word: one row per document and held item."""
    found = C.saved(leaks(docs, bench, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"))
    return rows.join(found, "text_key").drop("text_key")


def keep_clean(docs: DataFrame, bench: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns unchanged."""
    found = C.saved(leaks(docs, bench, text_col).select("text_key").distinct())
    packed = docs.select(F.struct("*").alias("row"), _text_key(text_col).alias("text_key"))
    return packed.join(found, "text_key", "left_anti").select("row.*")
