"""Operator 2: secret spans by base patterns and character Markov models.

Base spans are the leftmost, non-overlapping matches of three patterns.
The method adds spans: runs of 20 or more key characters outside the base
spans whose mean log-likelihood ratio between a first-order Markov model
of random strings and one of ordinary identifiers reaches ``THRESHOLD``.

The models are trained from labelled samples (s, secret), the caller's or
those of ``samples``. There, random strings are the base findings of all
documents that their form labels as random: access keys, hex strings, and
assigned values of letters and digits mixed (``changeme`` teaches nothing).
Ordinary identifiers are the runs of eight or more key characters, base
findings removed, of a bounded sample: the ``SAMPLE`` documents labelled
good (quality 1) that come first by a hash of their id. Both are smoothed
over 66 symbols (``ALPHA_RANDOM``, ``ALPHA_WORD``). The model is one array
of 128 x 128 log ratios, read by a scalar subquery.

A match's place is the summed length of the pieces between the matches and
of the matches before it, so places are code points and no text leaves its
row. Places are summed in blocks of matches, characters are split once, and
runs that touch a base span are found by masking the span instead of testing
every run against every span, so no step is quadratic in a text or its
matches. Only SQL functions are used.

Defined results: null text is empty; no span gives counts 0, the hash of
the empty string and an empty ``spans``; without findings or labels the
models are flat, all ratios 0 and no span is added; repeated rows are
scanned row by row; extra columns are ignored, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import saved

#: The base patterns and the shortest match that counts.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: (pattern, group that is the value, its least length) by kind number.
BASE = ((ASSIGN, 2, ASSIGN_VALUE), (ACCESS, 0, 1), (HEX, 0, 1))
KINDS = ("assign", "access", "hex", "markov")

#: A run of key characters; one that touches a masked character is none.
KEY_RUN = r"(?<![A-Za-z0-9+/_=\x01-])[A-Za-z0-9+/_=-]{20,}+(?!\x01)"
MASK = "\x01"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{8,}"
SAMPLE = 2000
#: Matches whose places are summed up at a time.
BLOCK = 1024
#: Pseudo-counts per symbol. Those of the random model are stronger, since
#: an even spread is what random strings have and few of them are labelled.
ALPHA_RANDOM, ALPHA_WORD = 4.0, 0.5
SYMBOLS = 66
#: Mean log ratio per transition. Measured: random keys of 32 letters and
#: digits 0.42 or more even where no secret is labelled (1.5 at sf0.1), runs
#: of the test prose -1.9 or less, CamelCase class names 0.1 to 0.9.
THRESHOLD = 0.3
_SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), then)[0]


def _running(lengths: Column, first) -> Column:
    """``first`` plus the running sums of a short array."""
    start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))
    return F.aggregate(lengths, start, step, lambda acc: acc["out"])


def _sums(lengths: Column) -> Column:
    """Running sums of an array of any length, by blocks of ``BLOCK``."""
    def whole(blocks):
        total = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        return _let(_running(total, F.lit(0)), lambda upto: F.flatten(F.transform(
            blocks, lambda b, j: _running(b, F.coalesce(F.get(upto, j - 1), F.lit(0))))))

    def blocks(a):
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(a) / BLOCK).cast("int")), lambda j: F.slice(a, j * BLOCK + 1, BLOCK))

    return _let(_let(lengths, blocks), whole)


def _pieces(text: Column, rx: str, value: int = 0) -> Column:
    """(piece, hit, value): matches of ``rx`` with the text before each; the
    last piece has no hit."""
    return F.arrays_zip(F.split(text, rx, -1).alias("piece"), F.regexp_extract_all(text, F.lit(rx), F.lit(0)).alias("hit"),
                        F.regexp_extract_all(text, F.lit(rx), F.lit(value)).alias("value"))


def _found(text: Column, rx: str, kind: int, value: int = 0, least: int = 1) -> Column:
    """Spans of the matches of ``rx``; those whose group ``value`` is
    shorter than ``least`` are dropped after matching."""
    def spans(hits):
        ends = _sums(F.transform(hits, lambda x: F.length(x["piece"]) + F.length(x["hit"])))
        every = F.zip_with(hits, ends, lambda x, stop: F.struct(
            (stop - F.length(x["hit"])).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), x["value"].alias("value")))
        return F.filter(every, lambda x: F.length(x["value"]) >= least)

    hits = F.filter(_pieces(text, rx, value), lambda x: x["hit"].isNotNull())
    return F.when(text.rlike(rx), _let(hits, spans)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    return F.concat(*[_found(text, rx, k, value, least) for k, (rx, value, least) in enumerate(BASE)])


def _masked(text: Column, rx: str, value: int, least: int) -> Column:
    """``text`` with its base spans of one kind masked; null where it has none."""
    plain = F.translate(text, MASK, "\x02")
    cover = F.transform(_pieces(plain, rx, value), lambda x: F.concat(x["piece"], F.when(
        F.length(x["value"]) >= least, F.repeat(F.lit(MASK), F.length(x["hit"]))).otherwise(F.coalesce(x["hit"], F.lit("")))))
    return F.when(text.rlike(rx), F.array_join(cover, ""))


def _runs(text: Column) -> Column:
    """start:value of the runs of key characters that touch no base span:
    those found whichever kind is masked."""
    def common(texts):
        found = F.transform(texts, lambda t: F.transform(
            _found(t, KEY_RUN, 3), lambda x: F.concat_ws(":", x["start"], x["value"])))
        return _let(found, lambda f: F.aggregate(f, f[0], lambda a, b: F.array_intersect(a, b)))

    masks = F.filter(F.array(*[_masked(text, *x) for x in BASE]), lambda m: m.isNotNull())
    plain = F.array(F.translate(text, MASK, "\x02"))
    return F.when(text.rlike(r"[A-Za-z0-9+/_=-]{20}"), _let(_let(masks, lambda m: F.when(F.size(m) > 0, m).otherwise(plain)), common)).otherwise(
        F.array().cast("array<string>"))


def _pairs(s: Column) -> Column:
    """Cells of the 128 x 128 table for the transitions of an ASCII string."""
    codes = F.transform(F.split(s, ""), lambda c: F.ascii(c))
    n = F.greatest(F.length(s) - 1, F.lit(0))
    return _let(codes, lambda c: F.zip_with(F.slice(c, 1, n), F.slice(c, 2, n), lambda x, y: x * 128 + y))


def samples(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled strings (s, secret 1 or 0) of the documents."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    hit = docs.where(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX))
    mixed = (F.col("x.kind") > 0) | (F.col("x.value").rlike("[0-9]") & F.col("x.value").rlike("[A-Za-z]"))
    random = hit.select(F.explode(base_spans(text)).alias("x")).where(mixed).select(F.col("x.value").alias("s"), F.lit(1).alias("secret"))
    good = (labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    plain = text
    for rx, _, _ in BASE:
        plain = F.regexp_replace(plain, rx, " ")
    words = (docs.join(F.broadcast(good), "doc_id", "left_semi")
             .select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("s"), F.lit(0).alias("secret")))
    return random.union(words)


def model(sample: DataFrame) -> DataFrame:
    """One row: the log ratios random / identifier by cell, from labelled
    strings (s, secret); what is not ASCII takes no part."""
    sample = sample.where(F.col("s").rlike(r"^[\x00-\x7F]{2,}$"))
    cells = (sample.select("secret", F.explode(_pairs(F.col("s"))).alias("cell"))
             .groupBy("cell").agg(F.sum("secret").alias("r"), F.sum(1 - F.col("secret")).alias("w")))
    cells = saved(cells)
    rows = cells.groupBy(F.floor(F.col("cell") / 128).alias("a")).agg(F.sum("r").alias("ra"), F.sum("w").alias("wa"))
    every = sample.sparkSession.range(0, 128 * 128, 1, 1).select(F.col("id").cast("int").alias("cell"))
    full = (every.join(cells, "cell", "left").join(rows, F.floor(F.col("cell") / 128) == F.col("a"), "left")
            .select("cell", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("r", "w", "ra", "wa")]))
    chance = lambda n, of, alpha: (F.col(n) + alpha) / (F.col(of) + alpha * SYMBOLS)
    full = full.select(F.struct("cell", F.log(chance("r", "ra", ALPHA_RANDOM) / chance("w", "wa", ALPHA_WORD)).alias("v")).alias("x"))
    return full.groupBy().agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["v"]).alias("m"))


def _joined(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"], x["stop"])), ",")


def scan(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sample: DataFrame | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov,
    found (array of start, kind number, stop, value) per row. ``sample``
    holds the caller's own labelled strings (s, secret)."""
    table = model(samples(docs, labels, id_col, text_col) if sample is None else sample).scalar()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), table.alias("table"))

    def spans(run):
        def one(part):
            start = part[0].cast("int")
            return F.struct(start.alias("start"), F.lit(3).alias("kind"), (start + F.length(part[1])).alias("stop"), part[1].alias("value"))
        return _let(F.split(run, ":"), one)

    def random(x):
        score = F.aggregate(_pairs(x["value"]), F.lit(0.0), lambda a, i: a + F.element_at(F.col("table"), i + 1))
        return score >= THRESHOLD * (F.length(x["value"]) - 1)

    more = F.filter(F.transform(_runs(F.col("text")), spans), random)
    both = rows.select("doc_id", F.transform(F.array(F.struct(F.array_sort(base_spans(F.col("text"))).alias("base"), more.alias("more"))),
                                             lambda x: x)[0].alias("x"))
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return (both.select("doc_id", "x.base", "x.more")
            .withColumn("found", F.array_sort(F.concat("base", "more")))
            .select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                    F.sha2(F.encode(_joined(F.col("base")), "utf-8"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
                    F.size("more").cast("long").alias("n_markov"), "found"))
