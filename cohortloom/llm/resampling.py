"""Operator 11: importance resampling towards a target distribution.

 1. A feature is a run of 1 to ``longest`` words; its bucket is the CRC-32
    of its text modulo ``buckets``. Each task counts its features in one
    array, and at most ``buckets`` rows a task are summed.
 2. The gain of a bucket is the log ratio of its smoothed shares in the
    target and in the corpus. All gains are one array of ``buckets`` whole
    numbers, the only thing that is sent to the tasks.
 3. A document's weight is the mean gain of its features, looked up in the
    array and summed per document. Weight plus seeded Gumbel noise is its
    score; the highest scores are a draw without replacement in proportion
    to the weights.
 4. The cutoff: a quantile sketch of the scores brackets the place asked
    for; exact counts above the bracket and inside it validate the bracket,
    which is widened until it holds the place; only its rows are sorted.
 5. What passes the cutoff is dealt by ranges of (score, id), numbered
    inside its range and shifted by the counts of the ranges before.

CRC-32 runs over the bytes of all words of a chunk at once; a pair goes on
from its first word's register.

Defined results: null, empty and wordless texts have no features and weight
0; of documents with less than ``least_words`` words none is drawn; ties of
score go to the smaller id, a null id last, hashed as an empty text; of
rows equal in score and id as many are drawn as fit; extra columns are
ignored; without documents the result is empty, and without benchmark texts
all target counts are 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm import common as C

BUCKETS = 10000
LONGEST = 2
LEAST_WORDS = 20
SEED = 7
#: Relative error of the sketch, and the first half width of the bracket, as shares of the rows.
ACCURACY = 1000
HALF_WIDTH = 0.004
#: Words that are hashed at a time, and the bytes from which a word is hashed alone.
_SLICE = 1 << 18
_LONG_WORD = 64


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> 1) ^ np.where(out & 1, np.uint32(0xEDB88320), np.uint32(0))
    return out


_CRC = _crc_table()


def _step(reg: np.ndarray, byte) -> np.ndarray:
    return _CRC[(reg ^ byte) & 255] ^ (reg >> 8)


def _advance(reg: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes ``data[start:end]`` of each word."""
    size = end - start
    order = np.argsort(-size.clip(max=_LONG_WORD + 1), kind="stable")
    s, n = start[order], size[order]
    out = reg[order]
    alone = int((n > _LONG_WORD).sum())
    for i in range(alone):
        out[i] = zlib.crc32(data[s[i]:s[i] + n[i]].tobytes(), int(~out[i])) ^ 0xFFFFFFFF
    s, n = s[alone:], n[alone:]
    live = out[alone:]
    for j in range(int(n[0]) if len(n) else 0):
        m = int(np.searchsorted(-n, -j, "left"))
        live[:m] = _step(live[:m], data[s[:m] + j])
    back = np.empty_like(out)
    back[order] = out
    return back


def _spans(data: np.ndarray, off: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, word starts, word ends, row of each word)."""
    fold, sep = table
    data = fold[data]
    word = ~sep[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = word & (edge[:-1] | ~np.r_[False, word[:-1]])
    last = word & (edge[1:] | ~np.r_[word[1:], False])
    s = np.flatnonzero(first)
    return data, s, np.flatnonzero(last) + 1, np.searchsorted(off, s, "right") - 1


def features(col: pa.Array, buckets: int, longest: int, table=C.PLAIN_WORDS):
    """(words a feature has, row of each feature, bucket of each feature),
    over pieces of the column."""
    data, off = C.text_bytes(col)
    for a, b in C.row_chunks(off):
        part, s, e, row = _spans(data[off[a]:off[b]], off[a:b + 1] - off[a], table)
        row += a
        for lo in range(0, len(s), _SLICE):
            hi = min(lo + _SLICE, len(s))
            at = np.arange(lo, hi)
            reg = _advance(np.full(hi - lo, 0xFFFFFFFF, np.uint32), part, s[lo:hi], e[lo:hi])
            for n in range(1, longest + 1):
                if n > 1:
                    on = np.flatnonzero((at + n - 1 < len(s)) & (row[np.minimum(at + n - 1, len(s) - 1)] == row[at]))
                    at, nxt = at[on], at[on] + n - 1
                    reg = _advance(_step(reg[on], np.uint32(0x20)), part, s[nxt], e[nxt])
                yield n, row[at], (~reg).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS, longest: int = LONGEST) -> dict[int, int]:
    """Features per bucket, at most ``buckets`` numbers."""
    def count(batches):
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, bucket in features(batch.column(0), buckets, longest):
                held += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], names=["bucket", "n"])

    rows = (texts.select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    return {r["bucket"]: r["n"] for r in rows}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for out, held in ((s, corpus), (t, target)):
        out[list(held)] = list(held.values())
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight."""
    buckets = len(gain)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            words, number, total = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for size, row, bucket in features(batch.column(1), buckets, longest):
                held = np.bincount(row, minlength=n)
                number += held
                if size == 1:
                    words += held
                np.add.at(total, row, gain[bucket])
            weight = np.where(number > 0, total // np.maximum(number, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, number, weight))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def gumbel(seed: int = SEED) -> Column:
    """floor(1000 times the Gumbel noise) of a row's id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def bracket(scores: DataFrame, n: int, k: int, half: float = HALF_WIDTH) -> tuple[int, int, int]:
    """(low, high, rows above high) with the k-th highest of ``n`` scores in
    low..high: a sketch's quantiles around its place, validated by exact
    counts outside and widened until they agree."""
    place = 1 - (k - 0.5) / n
    while True:
        ends = [max(0.0, place - half), min(1.0, place + half)]
        low, high = scores.agg(F.percentile_approx("score", ends, ACCURACY).alias("q")).first()["q"]
        if half >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, below = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") < low)).first()
        if above < k <= n - below:
            return low, high, above
        half *= 4


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``number``, 1, 2, 3... in the given order, without a
    window over all rows: ranges are numbered alone and shifted by the
    counts of the ranges before, one row a range."""
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.LongType()), T.StructField("inside", T.LongType())])

    def number(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(seen + 1, seen + n + 1))],
                                             names=[*batch.schema.names, "part", "inside"])
            seen += n

    rows = C.saved(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return rows.join(shift, "part").withColumn("number", F.col("shift") + F.col("inside")).drop("part", "inside", "shift")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = LEAST_WORDS, seed: int = SEED,
             buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is
    null for those not drawn."""
    gain = gains(bucket_counts(docs, text_col, buckets, longest), bucket_counts(target, target_col, buckets, longest), buckets)
    scored = C.saved(weigh(docs, gain, longest, id_col, text_col)
                     .withColumn("score", F.col("weight") + gumbel(seed)))
    able = scored.where(F.col("n_words") >= least_words)
    n = able.count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*columns, none)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    low, high, above = bracket(able, n, k)
    cut = (numbered(able.where(F.col("score").between(low, high)).select("score", "doc_id"), *order)
           .where(F.col("number") == k - above).first())
    tie = F.lit(True) if cut["doc_id"] is None else F.coalesce(F.col("doc_id") <= cut["doc_id"], F.lit(False))
    passes = (F.col("n_words") >= least_words) & ((F.col("score") > cut["score"]) | ((F.col("score") == cut["score"]) & tie))
    drawn = numbered(scored.where(passes).select(*columns), *order)
    rank = F.when(F.col("number") <= k, F.col("number"))
    return scored.where(~passes).select(*columns, none).union(drawn.select(*columns, rank))
