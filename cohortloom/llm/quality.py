"""Operator 6: quality rules by a hashed n-gram log-likelihood ratio.

Every document is scored by the mean, over its hashed word unigrams and
bigrams, of log p_target / p_raw. p_raw is the multinomial of all
documents; p_target is that of trusted documents (label quality = 1),
smoothed by ``PRIOR`` pseudo-counts per bucket in proportion to p_raw, so
that a bucket the trusted texts say nothing about scores 0. A document is
kept when the mean is at least ``THRESHOLD`` and the base rules hold.

The trusted texts are a classifier's training sample: the ``TRUSTED``
labelled rows that come first by a hash of their id. The raw counts cover
all documents. The weights are one array of ``BUCKETS`` doubles (512 KB,
whatever the input), read by a scalar subquery; texts are never shuffled.
Only SQL functions are used.

Defined results: null and empty texts have no words, all counts 0, score
0, and fail the base rule; without labels every weight is 0 and the base
rules decide alone; repeated rows are judged row by row; repeated labels
count once, a row is trusted if any of its labels says so; extra columns
are passed through or ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import SPACE_RX, SPACES, saved

BUCKETS = 1 << 16
PRIOR = 4.0
THRESHOLD = -0.15
TRUSTED = 20_000


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def word_array(text: Column) -> Column:
    body = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RX))


def _from_zero(n: Column) -> Column:
    """0..n-1, empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def grams(words: Column) -> Column:
    """Buckets of the unigrams and bigrams of a word array column."""
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    return F.concat(F.transform(words, lambda w: bucket(F.xxhash64(w))),
                    F.transform(_from_zero(F.size(words) - 1),
                                lambda i: bucket(F.xxhash64(words[i], words[i + 1]))))


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are first sorted as longs of 40 hash bits and 24 position
    bits, which leaves the positions whose hash bits meet another's; those
    few are then sorted again by their whole 64-bit hash.
    """
    low = F.lit(1 << 24)
    hashed = lambda w, i: F.xxhash64(w[i], w[i + 1], w[i + 2])
    high = lambda x: F.shiftright(x, 24)

    def meets(s, x, i, key):
        return (((i > 0) & (key(x) == key(s[F.greatest(i - 1, F.lit(0))])))
                | ((i < F.size(s) - 1) & (key(x) == key(s[F.least(i + 1, F.size(s) - 1)]))))

    def rough(w):
        n = F.size(w) - 2
        packed = F.transform(_from_zero(n), lambda i: F.shiftleft(high(hashed(w, i)), 24) + i)
        near = let(F.sort_array(packed), lambda s: F.transform(
            F.filter(s, lambda x, i: meets(s, x, i, high)), lambda x: F.pmod(x, low).cast("int")))
        return F.when(n > low, _from_zero(n)).otherwise(near)

    def exact(w, at):
        pairs = F.sort_array(F.transform(at, lambda i: F.struct(hashed(w, i).alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: meets(s, x, i, lambda y: y["h"])), lambda x: x["i"])))

    def covered(p):
        gaps = F.transform(p, lambda x, i: F.when(i < F.size(p) - 1, F.least(F.lit(3), p[F.least(i + 1, F.size(p) - 1)] - x))
                           .otherwise(F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(words, lambda w: let(rough(w), lambda at: F.when(F.size(at) == 0, F.lit(0).cast("long"))
                                    .otherwise(let(exact(w, at), covered))))


def measures(text: Column) -> dict[str, Column]:
    """The base measures that need no word array."""
    text = F.coalesce(text, F.lit(""))
    size = lambda c: F.length(c).cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    return {
        "word_chars": size(F.translate(text, SPACES, "")),
        "n_symbols": size(text) - size(F.translate(text, "#*$%&|<>", "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row: the array of log ratios by bucket."""
    trusted = (labels.where(F.col(label) == 1).select(F.col(label_id).cast("long").alias("id")).where("id is not null").distinct()
               .orderBy(F.xxhash64("id"), "id").limit(TRUSTED).withColumn("good", F.lit(1)))
    words = docs.select(F.col(id_col).cast("long").alias("id"), word_array(F.col(text_col)).alias("w"))
    flagged = words.join(F.broadcast(trusted), "id", "left")
    counts = saved(flagged.select("good", F.explode(grams(F.col("w"))).alias("bucket")).groupBy("bucket").agg(F.count("*").cast("double").alias("raw"), F.count("good").cast("double").alias("target")))
    total = counts.groupBy().agg(F.sum("raw").alias("r"), F.sum("target").alias("t"))
    r, t = total.select("r").scalar(), total.select("t").scalar()
    prior = PRIOR * BUCKETS
    ratio = F.log((F.col("target") / F.col("raw") * r + prior) / (t + prior))
    spark = docs.sparkSession
    full = (spark.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
            .select("bucket", F.coalesce(ratio, F.lit(0.0)).alias("v")))
    return full.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "v"))), lambda x: x["v"]).alias("w"))


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """``row`` (all input columns), word_chars, n_symbols, n_dup_lines and
    ``j``: n_words, n_repeat_words, score, base_failed, kept."""
    text, table = F.col("row")[text_col], F.col("table")

    def judged(w):
        g = grams(w)
        score = let(g, lambda b: F.when(F.size(b) == 0, F.lit(0.0)).otherwise(
            F.aggregate(b, F.lit(0.0), lambda a, x: a + F.element_at(table, x + 1)) / F.size(b)))
        counts = F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"), score.alias("score"))
        return let(counts, verdict)

    def verdict(x):
        failed = (x["n_words"] < 50) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
        return F.struct(x["n_words"].alias("n_words"), x["n_repeat_words"].alias("n_repeat_words"), x["score"].alias("score"),
                        failed.alias("base_failed"), (~failed & (x["score"] >= THRESHOLD)).alias("kept"))

    looked_up = weights(docs, labels, id_col, text_col, label_id, label).scalar()
    # everything that needs the words is one column, so a filter on it computes it once
    return docs.select(F.struct("*").alias("row"), looked_up.alias("table")).select(
        "row", *[c.alias(k) for k, c in measures(text).items()], let(word_array(text), judged).alias("j"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged."""
    return assess(docs, labels).where("j.kept").select("row.*")
