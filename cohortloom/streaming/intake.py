"""Structured Streaming forms of the intake jobs.

* Feedback records landing as JSON files are checked with the same
  column rules as the batch job and appended to an accepted and a
  rejected table. File sinks keep a commit log under the checkpoint, so
  a restarted query (lost executor, lost driver) neither drops nor
  duplicates a batch.
* Intraday app events are landed into ``suffix=YYYYMMDD`` folders, the
  layout the day-sharded batch report prunes on.
* Key-event counts per clock hour, by event time with a watermark: closed
  hours only, rows later than the watermark are lost. Where late rows must
  count and silent keys be reported, see ``streaming.monitor``.
* Landed shards that replace intraday days: both folders are one stream,
  and an event that comes twice is kept once.

Checkpoint folders must be on shared storage; callers pass them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cohortloom import schemas
from cohortloom.functions import params as P
from cohortloom.operators import feedback as FB
from cohortloom.operators.alerts import KEY_EVENTS
from cohortloom.sources import files as FI


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer


def land_feedback(spark: SparkSession, source: str, accepted_path: str, rejected_path: str) -> None:
    """Batch intake of a record folder: accepted records by demo, rejected
    ones (broken lines too, as they were read) with their reasons."""
    records = FI.read_feedback(spark, source)
    FI.append_feedback(FB.feedback_accepted(records), accepted_path)
    FB.feedback_rejected(records).drop("reasons").write.mode("append").parquet(rejected_path)


def feedback_intake_stream(spark: SparkSession, source: str, accepted_path: str, rejected_path: str,
                           checkpoint: str, available_now: bool = False,
                           interval: str | None = None) -> list[StreamingQuery]:
    """Start two queries over the same record folder: accepted records
    (partitioned by demo) and rejected ones with their reasons, lines that
    are no records among them."""
    records = FI.read_feedback(spark, source, streaming=True)
    accepted = FB.feedback_accepted(records)
    rejected = FB.feedback_rejected(records).drop("reasons")
    qa = _trigger(accepted.writeStream.format("parquet").partitionBy("demo")
                  .option("checkpointLocation", f"{checkpoint}/accepted")
                  .option("path", accepted_path).outputMode("append"), available_now, interval).start()
    qr = _trigger(rejected.writeStream.format("parquet")
                  .option("checkpointLocation", f"{checkpoint}/rejected")
                  .option("path", rejected_path).outputMode("append"), available_now, interval).start()
    return [qa, qr]


def land_intraday_stream(spark: SparkSession, source: str, target: str, checkpoint: str,
                         available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """App events (parquet files, warehouse schema) -> ``target/suffix=...``."""
    events = spark.readStream.schema(schemas.EVENTS).parquet(source)
    shaped = events.withColumn(schemas.SUFFIX, F.col("event_date"))
    writer = (shaped.writeStream.format("parquet").partitionBy(schemas.SUFFIX)
              .option("checkpointLocation", checkpoint).option("path", target).outputMode("append"))
    return _trigger(writer, available_now, interval).start()


def hourly_key_counts(events: DataFrame, key_events=None, watermark: str = "2 hours") -> DataFrame:
    """Streaming (or batch) counts per (country code, key event, hour) by
    event time. Late rows within the watermark still count; the state of
    closed hours is dropped."""
    names = list(key_events or KEY_EVENTS)
    timed = (events.where(F.col("event_name").isin(names))
             .withColumn("event_time", F.timestamp_micros(F.col("event_timestamp")))
             .withWatermark("event_time", watermark))
    return (timed.groupBy(F.window("event_time", "1 hour").alias("w"),
                          P.country_code(F.col("geo.country")).alias("dim"), "event_name")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("dim", "event_name",
                    F.floor(F.unix_micros(F.col("w.start")) / F.lit(3_600_000_000)).cast("bigint").alias("hour"),
                    "n"))


def hourly_monitor_stream(spark: SparkSession, source: str, target: str, checkpoint: str,
                          available_now: bool = False, interval: str | None = None,
                          watermark: str = "2 hours") -> StreamingQuery:
    """Append closed hours' counts to ``target`` (parquet)."""
    events = spark.readStream.schema(schemas.EVENTS).parquet(source)
    counts = hourly_key_counts(events, watermark=watermark)
    writer = (counts.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", target))
    return _trigger(writer, available_now, interval).start()


#: What tells two events apart; the id alone where it is given.
EVENT_KEY = ["event_id", "user_pseudo_id", "event_name", "event_timestamp"]


def changeover_stream(spark: SparkSession, daily: str, intraday: str, target: str, checkpoint: str,
                      delay: str = "3 days", available_now: bool = False, interval: str | None = None) -> StreamingQuery:
    """Intraday and landed day shards -> ``target/suffix=...``, each event
    once, whichever folder it comes from first.

    A landed shard repeats the events of its intraday days under the same
    ids; state keeps the ids for ``delay`` of event time, the longest time
    from an event to the landing of its day. Landed folders that are no
    days are not read. What a landed shard leaves out of its intraday day
    stays in ``target``: the batch union with its cut remains the truth."""
    schema = T.StructType([*schemas.EVENTS.fields, T.StructField(schemas.SUFFIX, T.StringType())])
    landed = spark.readStream.schema(schema).parquet(daily).where(F.col(schemas.SUFFIX).rlike(r"^[0-9]{8}$"))
    events = landed.unionByName(spark.readStream.schema(schema).parquet(intraday))
    once = (events.withColumn("event_time", F.timestamp_micros(F.col("event_timestamp")))
            .withWatermark("event_time", delay).dropDuplicatesWithinWatermark(EVENT_KEY).drop("event_time"))
    writer = (once.writeStream.format("parquet").partitionBy(schemas.SUFFIX).outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", target))
    return _trigger(writer, available_now, interval).start()
