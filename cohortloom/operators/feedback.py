"""R-9 / R-10: feedback records checked in bulk, triage routes, and
speech transcripts.

The per-record rules of the feedback form become column expressions
over a table of records (batch or stream). Transcripts are ordered line
joins per session; the ordering work is split by position buckets so a
session holding a third of all segments is not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.sources.files import BAD_LINE, bad_line_reason

LINE_BUCKET = 1024   # positions per bucket when numbering transcript lines


def js_trim(c: Column) -> Column:
    """Browser ``String.trim``: strips Unicode white space and line ends,
    not only spaces, from both ends (a character set, no regex)."""
    return F.trim(c, F.lit(dims.TRIM_SET))


def utf16_units(c: Column) -> Column:
    """Length as a browser counts it: a character beyond U+FFFF is two."""
    return F.octet_length(F.encode(c, "UTF-16BE")) / 2


def page_without_query(page: Column) -> Column:
    """Text before the first ``?``."""
    return F.split(page, r"\?").getItem(0)


def checked_feedback(records: DataFrame) -> DataFrame:
    """Records with cleaned fields, the list of failed rules and a flag.

    Rules: some text or an image; name at most 20 characters, text at
    most 2000, at most 9 images. As in a form field, characters are UTF-16
    units of the value as entered, before it is trimmed. A blank name
    becomes the anonymous name. A line that is no record (see
    ``sources.files.read_feedback``) fails with the reason why alone, and
    is kept as it was read.
    """
    raw_text, raw_name = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("name"), F.lit(""))
    text, name = js_trim(raw_text), js_trim(raw_name)
    images = F.coalesce(F.col("images"), F.array().cast("array<string>"))
    cleaned = records.select(
        *[c for c in records.columns if c not in ("name", "text", "images", "page")],
        F.when(name == "", F.lit(dims.ANONYMOUS_NAME)).otherwise(name).alias("name"),
        text.alias("text"), images.alias("images"),
        page_without_query(F.col("page")).alias("page"),
        utf16_units(raw_name).alias("name_units"), utf16_units(raw_text).alias("text_units"))
    reasons = F.array_compact(F.array(
        F.when((F.col("text") == "") & (F.size("images") == 0), F.lit("empty")),
        F.when(F.col("name_units") > dims.MAX_NAME_CHARS, F.lit("name_too_long")),
        F.when(F.col("text_units") > dims.MAX_TEXT_CHARS, F.lit("text_too_long")),
        F.when(F.size("images") > dims.MAX_IMAGES, F.lit("too_many_images")),
    ))
    if BAD_LINE in records.columns:
        reasons = F.when(F.col(BAD_LINE).isNull(), reasons).otherwise(F.array(bad_line_reason(F.col(BAD_LINE))))
    return (cleaned.select("*", reasons.alias("reasons"), (F.size(reasons) == 0).alias("accepted"))
            .drop("name_units", "text_units"))


def feedback_accepted(records: DataFrame) -> DataFrame:
    return checked_feedback(records).where(F.col("accepted")).drop("reasons", "accepted", BAD_LINE)


def feedback_rejected(records: DataFrame) -> DataFrame:
    return (checked_feedback(records).where(~F.col("accepted"))
            .withColumn("reason", F.array_join("reasons", ",")).drop("accepted"))


def feedback_missing_fields(records: DataFrame) -> DataFrame:
    """Entry rule of the feedback table: content (text or an image),
    submitter and source page must be filled. Lists what is missing per
    record, before any default name is applied."""
    blank = lambda c: c.isNull() | (js_trim(c) == "")
    no_content = blank(F.col("text")) & (F.coalesce(F.size("images"), F.lit(0)) <= 0)
    missing = F.array_compact(F.array(
        F.when(no_content, F.lit("content")),
        F.when(blank(F.col("name")), F.lit("submitter")),
        F.when(blank(F.col("page")), F.lit("source")),
    ))
    return (records.select("*", missing.alias("missing"))
            .where(F.size("missing") > 0)
            .withColumn("missing", F.array_join("missing", ",")))


def write_triage(triage: DataFrame, path: str) -> None:
    """Three-way split of triaged feedback, one folder per destination."""
    triage.write.mode("overwrite").partitionBy("destination").parquet(path)


def route_checks(triage: DataFrame) -> DataFrame:
    """Routed feedback (to the pool or to testing) must carry a link to the
    requirement it became."""
    routed = F.col("destination").isin("pool", "test")
    return triage.select("*", (routed & F.col("link").isNull()).alias("missing_link"))


def feedback_routes(triage: DataFrame, pool: DataFrame, release: DataFrame) -> DataFrame:
    """Triage counts per destination and the trace feedback -> requirement
    -> release (two left joins on the link). Records without a link, often
    most of them, trace to nothing and do not enter the joins."""
    t = route_checks(triage)
    titles = pool.select(F.col("title").alias("link"), F.lit(True).alias("in_pool")).dropDuplicates(["link"])
    names = release.select(F.col("name").alias("link"), F.lit(True).alias("in_release")).dropDuplicates(["link"])
    linked = t.where(F.col("link").isNotNull()).join(titles, "link", "left").join(names, "link", "left")
    wanted = ["destination", "missing_link", "in_pool", "in_release"]
    unlinked = t.where(F.col("link").isNull()).withColumns({c: F.lit(None).cast("boolean") for c in wanted[2:]})
    traced = linked.select(wanted).union(unlinked.select(wanted))
    return (traced.groupBy("destination")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.count_if("missing_link").alias("missing_link"),
                 F.count_if(F.coalesce(F.col("in_pool"), F.lit(False))).alias("in_pool"),
                 F.count_if(F.coalesce(F.col("in_release"), F.lit(False))).alias("in_release")))


def transcript_lines(segments: DataFrame, bucket: int = LINE_BUCKET) -> DataFrame:
    """Final segments, trimmed, blanks dropped, numbered in position order
    per session.

    Numbering is bucketed: per (session, pos bucket) counts give each
    bucket its offset, and rows are numbered inside their bucket, so no
    window sorts more than one bucket (or one session's bucket counts).
    """
    lines = (segments.where(F.col("is_final"))
             .select("session", "pos", js_trim(F.col("text")).alias("text"))
             .where(F.col("text") != "")
             .withColumn("bucket", F.floor(F.col("pos") / F.lit(bucket)).cast("bigint")))
    counts = lines.groupBy("session", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("session").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("session", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("session", "bucket").orderBy("pos")
    return (lines.join(offsets, ["session", "bucket"], "inner")
            .select("session", "pos", (F.col("offset") + F.row_number().over(inner)).alias("line_no"), "text"))


def transcript(segments: DataFrame, bucket: int = LINE_BUCKET) -> DataFrame:
    """One text per session: final pieces joined by a new line, in order.

    Built in two levels: a chunk per position bucket (bounded), then the
    chunks in bucket order. The result row holds the whole session text
    by definition; ``transcript_lines`` is the form for unbounded sessions.
    """
    lines = (segments.where(F.col("is_final"))
             .select("session", "pos", js_trim(F.col("text")).alias("text"))
             .where(F.col("text") != "")
             .withColumn("bucket", F.floor(F.col("pos") / F.lit(bucket)).cast("bigint")))
    chunks = (lines.groupBy("session", "bucket")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))),
                                            lambda x: x["text"]), "\n").alias("chunk"),
                   F.count(F.lit(1)).alias("n")))
    return (chunks.groupBy("session")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "chunk"))),
                                          lambda x: x["chunk"]), "\n").alias("text"),
                 F.sum("n").alias("lines")))
