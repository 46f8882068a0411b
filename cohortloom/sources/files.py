"""File sources and sinks: report CSV hand-over, daily report table,
JSON payload text, feedback JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas


def read_report_csv(spark: SparkSession, path: str, check_empty: bool = True) -> DataFrame:
    """Header CSV of the R-1 report; every cell is text on the wire, so it
    is read as text and cast by the declared schema. Empty input raises."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.SIGNUP_REPORT])
    raw = spark.read.option("header", True).schema(text_schema).csv(path)
    if check_empty and raw.isEmpty():
        raise ValueError("No CSV rows received")
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SIGNUP_REPORT])


def write_report_csv(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("header", True).csv(path)


def write_daily(report: DataFrame, path: str) -> None:
    """Daily report table partitioned by day. With dynamic partition
    overwrite, a rerun with the same cutoff replaces only the days it
    holds, which is how late events are restated."""
    (report.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("cohort_date").parquet(path))


def write_payloads(payloads: DataFrame, path: str) -> None:
    """One text line ``const NAME=<json>;`` per payload row."""
    (payloads.select(F.concat(F.lit("const "), F.col("name"), F.lit("="), F.col("payload"), F.lit(";"))
                     .alias("value"))
     .write.mode("overwrite").text(path))


#: Column that holds a line which is no feedback record, else null.
BAD_LINE = "line"


def read_feedback(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Feedback records from JSON lines (batch or stream) with the declared
    schema and ``line``: the text of a line that is broken or has a field
    of another type, null for a good one. Nothing is dropped; blank lines
    are no records."""
    lines = (spark.readStream if streaming else spark.read).text(path).where(F.trim("value") != "")
    schema = T.StructType([*schemas.FEEDBACK.fields, T.StructField(BAD_LINE, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    # a line that is JSON but no object gives no record and no corrupt text either
    whole = F.expr("try_variant_get(try_parse_json(value), '$', 'map<string,variant>')").isNotNull()
    return (lines.select(parsed.alias("r"), F.when(~whole, F.col("value")).alias("other"))
            .select(*[f"r.{f.name}" for f in schemas.FEEDBACK], F.coalesce(f"r.{BAD_LINE}", "other").alias(BAD_LINE)))


def bad_line_reason(line: Column) -> Column:
    """Why a line is no record; null for a good one."""
    return (F.when(line.isNull(), F.lit(None).cast("string"))
            .when(F.try_parse_json(line).isNull(), F.lit("not_json")).otherwise(F.lit("wrong_type")))


def append_feedback(df: DataFrame, path: str) -> None:
    """Append accepted records, text and images together, by demo."""
    df.write.mode("append").partitionBy("demo").parquet(path)
