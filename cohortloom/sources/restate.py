"""Restatement by changed days.

Late events land as further files of days that were read before. The
report's first aggregate has one row per (device, day) and depends on one
day's events only, so it is kept as a table and renewed for the days whose
files have changed; the report follows from it without the events.

A state folder has
 * ``days/run=N/suffix=D``: the device rows of the days that run N read;
 * ``log/run=N``: one row per day of the window: where its files came from
   (landed or intraday), their print, and the run that holds its rows.

A run compares the files of each day with the last log. Days with the same
print are left as they are: no file of theirs is read or written. The log
is written last and its run is the commit: a run that was lost before it
is done again with the same result, and readers see the last whole run. A
day that moves from intraday to landed, loses files or lands empty has
another print too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import dims
from cohortloom.operators import signup
from cohortloom.plans.materialize import materialize
from cohortloom.sources import events as E
from cohortloom.sources import shards as H

LOG = "suffix string, origin string, n_files long, print decimal(38,0), held_by int, device_days long"
EVENTS = [dims.FIRST_OPEN, dims.SIGNUP_RESULT]
_ORDER = [T.StructField("event_timestamp", T.LongType()), T.StructField("event_id", T.LongType())]
DAYS = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("fo", T.StructType([*_ORDER, T.StructField("platform", T.StringType()), T.StructField("country", T.StringType())])),
    T.StructField("su", T.StructType([T.StructField("no_method", T.IntegerType()), *_ORDER, T.StructField("method_raw", T.StringType())])),
    T.StructField(schemas.SUFFIX, T.StringType()),
])


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the whole runs below ``folder``."""
    path, fs = H._path(spark, folder)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("run=") and H.exists(spark, f"{folder}/{n}/_SUCCESS"))


def last_log(spark: SparkSession, state: str) -> DataFrame:
    """The log of the last whole run: a row per day; empty before it."""
    runs = _runs(spark, f"{state}/log")
    return spark.read.schema(LOG).parquet(f"{state}/log/run={runs[-1]}") if runs else spark.createDataFrame([], LOG)


def _shards(spark: SparkSession, base: str) -> DataFrame:
    """The events of a folder that may not have been made yet."""
    if H.exists(spark, base):
        return E.read_shards(spark, base)
    return spark.createDataFrame([], T.StructType([*schemas.EVENTS.fields, T.StructField(schemas.SUFFIX, T.StringType())]))


def day_state(spark: SparkSession, daily: str, intraday: str, start_date, landed_max: str | None, as_of) -> DataFrame:
    """(suffix, origin, n_files, print) of the days that a report reads."""
    landed = H.day_files(spark, daily).where(E.daily_filter(start_date, landed_max))
    open_days = H.day_files(spark, intraday).where(E.intraday_filter(landed_max, as_of))
    parts = [H.day_prints(f).withColumn("origin", F.lit(o)) for f, o in ((landed, "landed"), (open_days, "intraday"))]
    return parts[0].unionByName(parts[1])


def refresh_days(spark: SparkSession, daily: str, intraday: str, state: str, start_date, as_of) -> list[str]:
    """Bring the kept device days up to the files; returns the days whose
    files have changed since the last run (one name a day)."""
    cut = E.landed_max(spark, base=daily)
    old = last_log(spark, state)
    now = day_state(spark, daily, intraday, start_date, cut, as_of)
    was = old.select("suffix", F.col("print").alias("old_print"), F.col("origin").alias("old_origin"), "held_by",
                     F.col("device_days").alias("old_days"))
    both = materialize(now.join(was, "suffix", "full"), "days")
    same = F.col("print").eqNullSafe(F.col("old_print")) & F.col("origin").eqNullSafe(F.col("old_origin"))
    touched = sorted(r["suffix"] for r in both.where(~same).select("suffix").collect())
    if not touched:
        return []
    run = max(_runs(spark, f"{state}/log"), default=0) + 1
    ev = E.union_events(_shards(spark, daily), _shards(spark, intraday), start_date, cut, as_of,
                        EVENTS, (*E.EXTRA, schemas.SUFFIX)).where(F.col(schemas.SUFFIX).isin(touched))
    held = signup.device_days(ev.withColumn("event_date", F.struct("event_date", schemas.SUFFIX)))
    held.select("user_pseudo_id", "event_date.event_date", "fo", "su", f"event_date.{schemas.SUFFIX}").write.mode(
        "overwrite").partitionBy(schemas.SUFFIX).parquet(f"{state}/days/run={run}")
    sizes = _read_days(spark, state, [f"{state}/days/run={run}"]).groupBy(schemas.SUFFIX).agg(F.count(F.lit(1)).alias("new_days"))
    log = (both.where("origin is not null").join(sizes, "suffix", "left")
           .select("suffix", "origin", "n_files", "print",
                   F.when(same, F.col("held_by")).otherwise(F.lit(run)).alias("held_by"),
                   F.when(same, F.col("old_days")).otherwise(F.coalesce("new_days", F.lit(0))).alias("device_days")))
    log.coalesce(1).write.mode("overwrite").parquet(f"{state}/log/run={run}")
    return touched


def _read_days(spark: SparkSession, state: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(DAYS).option("basePath", f"{state}/days").parquet(*paths)


def kept_days(spark: SparkSession, state: str) -> DataFrame:
    """The device days of the last whole run; each day is read from the
    run that holds it."""
    log = last_log(spark, state).where("device_days > 0").select("suffix", "held_by").collect()   # a row a day
    paths = [f"{state}/days/run={r['held_by']}/{schemas.SUFFIX}={r['suffix']}" for r in log]
    return _read_days(spark, state, paths) if paths else spark.createDataFrame([], DAYS)


def restate_report(spark: SparkSession, state: str, path: str, country_map=None, methods=None) -> list[str]:
    """Bring the daily report at ``path`` up to the kept device days. Only
    report days whose rows differ are written (a late first open also takes
    its device out of a later day); returns them."""
    # one row per (device, date) again where a date's events lie in two shards
    days = kept_days(spark, state).groupBy("user_pseudo_id", "event_date").agg(F.min("fo").alias("fo"), F.min("su").alias("su"))
    new = materialize(signup.country_counts(signup.device_cohorts(days, country_map, methods), methods), "report")
    schema = T.StructType(schemas.SIGNUP_REPORT.fields)
    old = spark.read.schema(schema).parquet(path) if H.exists(spark, path) else spark.createDataFrame([], schema)
    columns = [f.name for f in schema]

    def prints(report: DataFrame, name: str) -> DataFrame:
        one = F.xxhash64(*columns).cast("decimal(38,0)")
        return report.groupBy("cohort_date").agg(F.struct(F.count(F.lit(1)), F.sum(one)).alias(name))

    differ = (prints(new, "new").join(prints(old, "old"), "cohort_date", "full")
              .where(~F.col("new").eqNullSafe(F.col("old")))
              .select(F.col("cohort_date").cast("string").alias("d"), F.col("new").isNull().alias("gone")).collect())
    if any(not r["gone"] for r in differ):
        rows = new.where(F.col("cohort_date").cast("string").isin([r["d"] for r in differ if not r["gone"]]))
        (rows.select(*columns).repartition("cohort_date").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("cohort_date").parquet(path))
    for r in differ:
        if r["gone"]:
            H.remove(spark, f"{path}/cohort_date={r['d']}")
    return sorted(r["d"] for r in differ)
