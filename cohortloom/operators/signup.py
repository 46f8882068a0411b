"""R-1: first-open cohort × country × sign-up method, per day.

Plan shape (see ``explain``): each branch of the day union prunes days
by ``PartitionFilters`` and pushes ``event_name IN (...)`` to the scan.
"First row per key" is an aggregate ``min(struct(order keys, payload))``
instead of ``row_number() = 1``: it combines map-side (as a sort-based
aggregate, since structs have no fixed width), so a hot device id (null
ids, test devices) collapses to one row per map task before the shuffle.
Each day is read once: first open and sign-up are two conditional minima
of the same (device, day) group, the device's first open carries the
sign-up of its own day along, and no join is needed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.functions import params as P
from cohortloom.sources import events as S

REPORT_COLUMNS = ["cohort_date", "country_code", "first_opens", "registered", "registered_rate",
                  "google", "phone", "apple", "facebook", "kakao", "unknown",
                  "android_first_opens", "android_registered"]


def _tie_columns(df: DataFrame) -> list[str]:
    return ["event_id"] if "event_id" in df.columns else []


def first_open(events: DataFrame, country_map=None) -> DataFrame:
    """One row per device: its first ``first_open`` by time inside the
    scanned window. Country and platform come from that row."""
    ties = _tie_columns(events)
    first = (events.where(F.col("event_name") == dims.FIRST_OPEN)
             .groupBy("user_pseudo_id")
             .agg(F.min(F.struct(F.col("event_timestamp"), *[F.col(c) for c in ties],
                                 F.col("event_date"), F.col("platform"),
                                 F.col("geo.country").alias("country"))).alias("w")))
    return first.select(
        "user_pseudo_id",
        F.to_date(F.col("w.event_date"), "yyyyMMdd").alias("cohort_date"),
        F.col("w.platform").alias("platform"),
        F.col("w.country").alias("country"),
        P.country_code(F.col("w.country"), country_map).alias("country_code"),
    )


def signup_shaped(events: DataFrame, strict: bool = False) -> DataFrame:
    """Sign-up rows with the raw method and the success value."""
    ties = _tie_columns(events)
    return (events.where(F.col("event_name") == dims.SIGNUP_RESULT)
            .select("user_pseudo_id",
                    F.to_date(F.col("event_date"), "yyyyMMdd").alias("signup_date"),
                    "event_timestamp", *ties,
                    P.signup_method_raw(strict=strict).alias("method_raw"),
                    P.success_value(strict=strict).alias("success_value")))


def signup_first(events: DataFrame, methods=None, success_values=None, strict: bool = False) -> DataFrame:
    """One row per (device, day): the first successful sign-up, rows with
    a (non-null) method before rows without, then by time.

    "Valid method" means non-null: an unlisted method still beats null
    and is then reported as ``unknown``.
    """
    vals = list(success_values or dims.SUCCESS_VALUES)
    shaped = signup_shaped(events, strict)
    ties = _tie_columns(shaped)
    ranked = (shaped.where(F.col("success_value").isin(vals))
              .groupBy("user_pseudo_id", "signup_date")
              .agg(F.min(F.struct(F.col("method_raw").isNull().cast("int").alias("no_method"),
                                  F.col("event_timestamp"), *[F.col(c) for c in ties],
                                  F.col("method_raw"))).alias("w")))
    return ranked.select("user_pseudo_id", "signup_date",
                         P.recode_method(F.col("w.method_raw"), methods).alias("signup_method"))


def device_days(events: DataFrame, success_values=None, strict: bool = False) -> DataFrame:
    """One row per (device, day): its first open ``fo`` and its first
    successful sign-up ``su``, null where the day has none. A day's rows
    depend on that day's events only, so days can be kept and renewed one
    by one (``sources.restate``)."""
    ties = [F.col(c) for c in _tie_columns(events)]
    order = [F.col("event_timestamp"), *ties]
    raw = P.signup_method_raw(strict=strict)
    signed = ((F.col("event_name") == dims.SIGNUP_RESULT)
              & P.success_value(strict=strict).isin(list(success_values or dims.SUCCESS_VALUES)))
    return (events.groupBy("user_pseudo_id", "event_date")
            .agg(F.min(F.when(F.col("event_name") == dims.FIRST_OPEN,
                              F.struct(*order, "platform", F.col("geo.country").alias("country")))).alias("fo"),
                 F.min(F.when(signed, F.struct(raw.isNull().cast("int").alias("no_method"), *order,
                                               raw.alias("method_raw")))).alias("su")))


def device_cohorts(days: DataFrame, country_map=None, methods=None) -> DataFrame:
    """One row per device from its ``device_days``: its first open and the
    first successful sign-up of that day. A null device never counts as
    registered."""
    first = (days.where(F.col("fo").isNotNull()).groupBy("user_pseudo_id")
             .agg(F.min(F.struct("fo", "event_date", "su")).alias("w")))
    known = F.col("user_pseudo_id").isNotNull() & F.col("w.su").isNotNull()
    return first.select("user_pseudo_id", F.to_date(F.col("w.event_date"), "yyyyMMdd").alias("cohort_date"),
                        F.col("w.fo.platform").alias("platform"),
                        P.country_code(F.col("w.fo.country"), country_map).alias("country_code"),
                        F.when(known, P.recode_method(F.col("w.su.method_raw"), methods)).alias("signup_method"))


def cohort_days(events: DataFrame, country_map=None, methods=None, success_values=None, strict: bool = False) -> DataFrame:
    """One row per device: its first open and the first successful sign-up
    of that day, from one pass. The same rules as ``first_open`` and
    ``signup_first``."""
    return device_cohorts(device_days(events, success_values, strict), country_map, methods)


def country_counts(cohorts: DataFrame, methods=None) -> DataFrame:
    """Counts per (day, country) from ``cohort_days``."""
    reg = F.col("signup_method").isNotNull()
    android = F.col("platform") == F.lit(dims.PLATFORM)
    method_counts = [F.count_if(F.col("signup_method") == F.lit(m)).alias(m)
                     for m in list(methods or dims.SIGNUP_METHODS) + [dims.UNKNOWN_METHOD]]
    opens, registered = F.count(F.lit(1)), F.count_if(reg)
    return cohorts.groupBy("cohort_date", "country_code").agg(
        opens.alias("first_opens"), registered.alias("registered"),
        F.round(F.try_divide(registered, opens) * 100, 1).cast("double").alias("registered_rate"),
        *method_counts, F.count_if(android).alias("android_first_opens"),
        F.count_if(android & reg).alias("android_registered"))


def signup_country_method_daily(daily: DataFrame, intraday: DataFrame, start_date=dims.DEFAULT_START_DATE,
                                landed_max: str | None = None, as_of=None, country_map=None,
                                methods=None, strict: bool = False, ordered: bool = True) -> DataFrame:
    """R-1. ``landed_max`` is the last landed day (see
    ``sources.events.landed_max``); ``as_of`` defaults to today in UTC
    but should be passed so reruns repeat."""
    if as_of is None:
        as_of = _dt.datetime.now(_dt.timezone.utc).date()
    ev = S.union_events(daily, intraday, start_date, landed_max, as_of,
                        [dims.FIRST_OPEN, dims.SIGNUP_RESULT])
    report = country_counts(cohort_days(ev, country_map, methods, strict=strict), methods)
    return report.orderBy("cohort_date", "country_code") if ordered else report
