"""R-7: data-quality alerts.

Zero hours never appear in event data. A zero run is the gap between two
neighbouring hours with events, or between the first or last of them and
the edges of the period: ``lag(hour)`` per key over the hourly counts and
one closing row per key, no hour grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.functions import params as P
from cohortloom.operators import funnel as FN
from cohortloom.sources import events as E

HOUR_MICROS = 3_600_000_000
KEY_EVENTS = [dims.FIRST_OPEN, dims.SIGNUP_RESULT, dims.ASSIGN_EVENT]


def hour_index(ts_micros: Column) -> Column:
    return F.floor(ts_micros / F.lit(HOUR_MICROS)).cast("bigint")


def hour_text(idx: Column) -> Column:
    return F.date_format(F.timestamp_micros(idx * F.lit(HOUR_MICROS)), "yyyy-MM-dd HH:mm")


def hourly_counts(events: DataFrame, key_events=None, dim: Column | None = None, start=None, end=None) -> DataFrame:
    """(dim, event_name, hour) -> events of ``[start, end)``; only hours
    that have events. On day shards both ends prune days."""
    events = E.between_times(events, start, end)
    names = list(key_events or KEY_EVENTS)
    d = dim if dim is not None else P.country_code(F.col("geo.country"), dims.FUNNEL_COUNTRY_CODES)
    return (events.where(F.col("event_name").isin(names))
            .groupBy(d.alias("dim"), "event_name", hour_index(F.col("event_timestamp")).alias("hour"))
            .agg(F.count(F.lit(1)).alias("n")))


def zero_runs(events: DataFrame, start, as_of, key_events=None, dim: Column | None = None, dim_values=None,
              min_hours: int = dims.ZERO_RUN_HOURS) -> DataFrame:
    """Runs of at least ``min_hours`` consecutive clock hours (UTC) with no
    event in ``[start, as_of)``, per (dim, key event). Every listed dim
    value has every key event, so a key that never fires is one run. A
    caller's ``dim`` without ``dim_values`` lists the values its key events
    have in that time."""
    lo, hi = E.to_micros(start), E.to_micros(as_of)
    names = list(key_events or KEY_EVENTS)
    counts = hourly_counts(events, names, dim, start, as_of)
    if dim is not None and dim_values is None:
        dim_values = counts.select("dim").where("dim is not null").distinct()
    return zero_runs_from_counts(counts, lo // HOUR_MICROS, -(-hi // HOUR_MICROS), names, dim_values, min_hours)


def zero_runs_from_counts(counts: DataFrame, first_hour: int, end_hour: int, key_events=None, dim_values=None,
                          min_hours: int = dims.ZERO_RUN_HOURS) -> DataFrame:
    """Zero runs in hours ``first_hour <= hour < end_hour`` from (dim,
    event_name, hour, n) counts, e.g. the output of the hourly monitor.
    ``dim_values`` is a list, or a frame (dim) of all values in the counts."""
    names = list(key_events or KEY_EVENTS)
    if isinstance(dim_values, DataFrame):
        listed = F.col("dim").isNotNull()
        ends = dim_values.select("dim", F.explode(F.array(*map(F.lit, names))).alias("event_name"), F.lit(end_hour).cast("bigint").alias("hour"))
    else:
        values = list(dim_values or [c for _, c in dims.FUNNEL_COUNTRY_CODES] + [dims.OTHER_COUNTRY])
        listed = F.col("dim").isin(values)
        closing = [(d, n, end_hour) for d in values for n in names]
        ends = counts.sparkSession.createDataFrame(closing, "dim string, event_name string, hour bigint")
    seen = (counts.where(listed & F.col("event_name").isin(names) & (F.col("n") > 0)
                         & F.col("hour").between(first_hour, end_hour - 1))
            .select("dim", "event_name", "hour"))
    w = Window.partitionBy("dim", "event_name").orderBy("hour")
    gaps = seen.union(ends).select("dim", "event_name", "hour",
                                   F.coalesce(F.lag("hour").over(w), F.lit(first_hour - 1)).alias("before"))
    hours = F.col("hour") - F.col("before") - 1
    return (gaps.where(hours >= F.lit(min_hours))
            .select(F.col("dim").alias("country_code"), "event_name", hour_text(F.col("before") + 1).alias("zero_from"),
                    hour_text(F.col("hour") - 1).alias("zero_to"), hours.alias("zero_hours")))


def version_key(v: Column) -> Column:
    """``1.4.10`` -> [1, 4, 10] for numeric ordering; a leading V is dropped."""
    return F.transform(F.split(F.regexp_replace(v, r"^[Vv]", ""), r"\."), lambda x: x.try_cast("int"))


def version_drop(reach_by_version: DataFrame, drop: float = dims.VERSION_DROP) -> DataFrame:
    """Reach rate per (group, version, step) against the previous version;
    alert when it falls by ``drop`` or more (relative)."""
    w_base = Window.partitionBy("grp", "app_version").orderBy("step_no").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rated = reach_by_version.select(
        "grp", "app_version", "step_no", "step", "reached",
        F.round(F.try_divide(F.col("reached").cast("double"),
                             F.first("reached").over(w_base).cast("double")), 6).alias("rate"))
    w = Window.partitionBy("grp", "step_no").orderBy(version_key(F.col("app_version")))
    prev = F.lag("rate").over(w)
    prev_v = F.lag("app_version").over(w)
    out = rated.select("*", prev_v.alias("prev_version"), prev.alias("prev_rate"))
    fall = F.round(F.lit(1.0) - F.try_divide(F.col("rate"), F.col("prev_rate")), 6)
    return out.select("grp", "app_version", "step_no", "step", "reached", "rate", "prev_version", "prev_rate",
                      fall.alias("fall"),
                      F.coalesce((F.col("prev_rate") > 0) & (fall >= F.lit(drop)), F.lit(False)).alias("is_drop"))


def event_completeness(reach_by_version: DataFrame, steps=None, gaps=None) -> DataFrame:
    """Devices per (group, version, step) on the dense grid of every
    version seen × the group's steps. ``is_gap``: no device in this
    version while another version of the same group and step has some."""
    spark = reach_by_version.sparkSession
    # group and version pairs of every version seen, joined to the group's steps
    listed = FN.steps_frame(spark, steps).select("grp", "step_no", "step").distinct()
    groups = F.array(*[F.lit(g) for g in dims.GROUPS])
    seen = reach_by_version.select("app_version").distinct().select("app_version", F.explode(groups).alias("grp"))
    grid = seen.join(listed, "grp")
    n = (grid.join(reach_by_version.select("grp", "app_version", "step_no", "hit"),
                   ["grp", "app_version", "step_no"], "left")
         .select("grp", "app_version", "step_no", "step", F.coalesce(F.col("hit"), F.lit(0)).alias("n_devices")))
    w = Window.partitionBy("grp", "step_no")
    known = (FN.gaps_frame(spark, gaps).select("grp", "app_version", "step").distinct()
             .withColumn("is_known_gap", F.lit(True)))
    return (n.select("*", ((F.col("n_devices") == 0) & (F.max("n_devices").over(w) > 0)).alias("is_gap"))
            .join(known, ["grp", "app_version", "step"], "left")
            .select("grp", "app_version", "step_no", "step", "n_devices", "is_gap",
                    F.coalesce(F.col("is_known_gap"), F.lit(False)).alias("is_known_gap")))


def reach_by_version(devices: DataFrame, steps=None) -> DataFrame:
    """Funnel reach per (group, version, step), without an "all" row."""
    return FN.funnel_reach(devices, steps, by=("app_version",), with_all=False)
