"""Hourly monitor of key events that loses no late row and reports silence.

Every micro-batch is counted per (dim, key event, clock hour) and written
as the batch's own table ``counts/batch=N``. A batch that is run again
after a failure writes the same table again, so nothing counts twice; late
rows are further counts of an old hour, so nothing is lost. Every
``fold_every`` batches the counts so far are folded into one table
``folded/batch=N``, so that a read takes one folded table and a bounded
number of batch tables.

The stream's clock is the latest hour of any event, key event or not: it
runs on while a key is silent. After each batch the last seen hour of every
key and the zero runs up to the clock are written for that batch. A run
that reaches the clock is still open: its key is silent now. A late row
that ends or splits a run is in the next batch's tables, and only the last
batch's tables hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortloom import schemas
from cohortloom.functions import dims
from cohortloom.functions import params as P
from cohortloom.operators import alerts as A
from cohortloom.operators import experiment as X
from cohortloom.sources import shards as H
from cohortloom.streaming.intake import _trigger

#: Name under which events that are no key events are counted: the clock.
CLOCK = ""
COUNTS = "dim string, event_name string, hour long, n long"
SEEN = "dim string, event_name string, last_hour long, silent_hours long"
RUNS = "country_code string, event_name string, zero_from string, zero_to string, zero_hours long, is_open boolean"


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the whole tables below ``folder``."""
    path, fs = H._path(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch=") and H.exists(spark, f"{folder}/{n}/_SUCCESS"))


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def all_counts(spark: SparkSession, store: str, upto: int | None = None) -> DataFrame:
    """(dim, event_name, hour, n) up to a batch, the clock's rows too."""
    within = lambda kind: [b for b in _batches(spark, f"{store}/{kind}") if upto is None or b <= upto]
    folded = within("folded")[-1:]
    paths = [f"{store}/folded/batch={b}" for b in folded]
    paths += [f"{store}/counts/batch={b}" for b in within("counts") if not folded or b > folded[0]]
    return _read(spark, paths, COUNTS).groupBy("dim", "event_name", "hour").agg(F.sum("n").alias("n"))


def key_counts(spark: SparkSession, store: str) -> DataFrame:
    """Key events per hour: the batch job's ``hourly_counts``."""
    return all_counts(spark, store).where(F.col("event_name") != CLOCK)


def last_seen(spark: SparkSession, store: str) -> DataFrame:
    """The last hour of every key that was seen, and its hours of silence."""
    return _read(spark, [f"{store}/seen/batch={b}" for b in _batches(spark, f"{store}/seen")[-1:]], SEEN)


def zero_alerts(spark: SparkSession, store: str) -> DataFrame:
    """Zero runs as of the last batch."""
    return _read(spark, [f"{store}/runs/batch={b}" for b in _batches(spark, f"{store}/runs")[-1:]], RUNS)


def _take(batch: DataFrame, number: int, store: str, first_hour: int, names: list[str], dim: Column, dim_values,
          min_hours: int, allow: int, fold_every: int) -> None:
    spark = batch.sparkSession
    is_key = F.col("event_name").isin(names)
    counts = (batch.where(F.col("event_timestamp").isNotNull())
              .groupBy(F.when(is_key, dim).alias("dim"), F.when(is_key, F.col("event_name")).otherwise(F.lit(CLOCK)).alias("event_name"),
                       A.hour_index(F.col("event_timestamp")).alias("hour"))
              .agg(F.count(F.lit(1)).alias("n")))
    counts.write.mode("overwrite").parquet(f"{store}/counts/batch={number}")
    if (number + 1) % fold_every == 0:
        all_counts(spark, store, number).coalesce(1).write.mode("overwrite").parquet(f"{store}/folded/batch={number}")
    held = all_counts(spark, store, number)
    clock = held.agg(F.max("hour").alias("h")).first()["h"]
    if clock is None:
        return
    keys = held.where(F.col("event_name") != CLOCK)
    seen = keys.groupBy("dim", "event_name").agg(F.max("hour").alias("last_hour"))
    seen.select("*", (F.lit(clock) - F.col("last_hour")).alias("silent_hours")).write.mode("overwrite").parquet(f"{store}/seen/batch={number}")
    # the clock's own hour is not over; ``allow`` hours before it may still get rows
    end = clock - allow
    values = dim_values if dim_values is not None else keys.select("dim").where("dim is not null").distinct()
    runs = A.zero_runs_from_counts(keys, first_hour, end, names, values, min_hours)
    runs.select("*", (F.col("zero_to") == A.hour_text(F.lit(end - 1))).alias("is_open")).write.mode("overwrite").parquet(
        f"{store}/runs/batch={number}")


def zero_monitor_stream(spark: SparkSession, source: str, store: str, checkpoint: str, start, key_events=None,
                        dim: Column | None = None, dim_values=None, min_hours: int = dims.ZERO_RUN_HOURS, allow_hours: int = 0,
                        fold_every: int = 48, files_per_batch: int | None = None, available_now: bool = False,
                        interval: str | None = None) -> StreamingQuery:
    """Monitor an event folder from ``start`` on. ``allow_hours`` keeps back
    runs that end so close to the clock; ``dim_values`` lists the values that
    must not fall silent (by default the funnel's countries, or with a
    ``dim`` of the caller all values seen)."""
    names = list(key_events or A.KEY_EVENTS)
    if dim is None:
        dim_values = dim_values or [c for _, c in dims.FUNNEL_COUNTRY_CODES] + [dims.OTHER_COUNTRY]
        dim = P.country_code(F.col("geo.country"), dims.FUNNEL_COUNTRY_CODES)
    first_hour = X.to_micros(start) // A.HOUR_MICROS
    reader = spark.readStream.schema(schemas.EVENTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, number: int) -> None:
        _take(batch, number, store, first_hour, names, dim, dim_values, min_hours, allow_hours, fold_every)

    writer = reader.parquet(source).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()
