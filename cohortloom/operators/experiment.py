"""R-4: experiment assignment status per device.

One aggregation over assignment events by device: boolean ``bool_or``
flags per group (fixed-width buffers, combined map-side) and the first
assignment as ``min(struct(ts, id, ...))``. A device holding a third
of all assignment events is reduced to one row per map task before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.functions import params as P
from cohortloom.sources.events import between_times, to_micros

STATUS_FALLBACK = "fallback"
STATUS_CONFLICT = "conflict"
STATUS_NONE = "none"


def assignment_events(events: DataFrame, experiment: str = dims.EXPERIMENT, cutoff=None, since=None) -> DataFrame:
    """App events -> flat assignment rows of one experiment, before
    ``cutoff``. ``since`` is the day the experiment began, before which no
    device can have been assigned; it must not be later than the first
    assignment, as a window tests a device's first one. On day shards both
    prune days."""
    events = between_times(events, since, cutoff)
    ties = [F.col("event_id")] if "event_id" in events.columns else [F.lit(None).cast("bigint").alias("event_id")]
    return (events.where(F.col("event_name") == dims.ASSIGN_EVENT)
            .select("user_pseudo_id", "event_timestamp", *ties,
                    P.param("experiment").alias("experiment"),
                    P.param("group").alias("grp"),
                    F.col("geo.country").alias("country"),
                    F.col("app_info.version").alias("app_version"),
                    "platform")
            .where(F.col("experiment") == F.lit(experiment)))


def assignment_status(assign: DataFrame, start, cutoff, platform: str | None = dims.PLATFORM,
                      groups=None, country_map=None) -> DataFrame:
    """One row per device first assigned in ``[start, cutoff)``.

    Events at or after ``cutoff`` are ignored, so a rerun with the same
    cutoff repeats. Status: ``fallback`` if any fallback assignment, else
    ``conflict`` if more than one group, else the single group. Country
    and version come from the first stable (A/B) assignment.
    """
    gs = list(groups or dims.GROUPS)
    lo, hi = to_micros(start), to_micros(cutoff)
    rows = assign.where(F.col("event_timestamp") < F.lit(hi))
    if platform is not None:
        rows = rows.where(F.col("platform") == F.lit(platform))
    grp = F.col("grp")
    stable = grp.isin(gs)
    flags = [F.bool_or(grp == F.lit(g)).alias(f"has_{g}") for g in gs]
    per_device = (rows.groupBy("user_pseudo_id")
                  .agg(F.min("event_timestamp").alias("first_ts"),
                       F.bool_or(grp == F.lit(dims.FALLBACK_GROUP)).alias("is_fallback"),
                       *flags,
                       F.min(F.when(stable, F.struct("event_timestamp", "event_id", "country",
                                                     "app_version"))).alias("fs")))
    n_groups = sum(F.col(f"has_{g}").cast("int") for g in gs)
    status = F.when(F.col("is_fallback"), F.lit(STATUS_FALLBACK)).when(n_groups > 1, F.lit(STATUS_CONFLICT))
    for g in gs:
        status = status.when(F.col(f"has_{g}"), F.lit(g))
    status = status.otherwise(F.lit(STATUS_NONE))
    return (per_device.where(F.col("first_ts") >= F.lit(lo))
            .select("user_pseudo_id",
                    status.alias("status"),
                    F.when(status.isin(gs), status).alias("grp"),
                    "first_ts",
                    F.col("fs.event_timestamp").alias("stable_ts"),
                    F.col("fs.country").alias("country"),
                    P.country_code(F.col("fs.country"), country_map or dims.FUNNEL_COUNTRY_CODES)
                    .alias("country_code"),
                    F.col("fs.app_version").alias("app_version"),
                    "is_fallback",
                    (n_groups > 1).alias("is_conflict")))


def stable_devices(status: DataFrame) -> DataFrame:
    """Stable A/B devices only; conflict and fallback do not enter the funnel."""
    return status.where(F.col("grp").isNotNull())


def health_counts(status: DataFrame) -> DataFrame:
    """Fallback share (of all assigned devices) and conflict count, with
    the spec's alert thresholds. A device with two groups and a fallback
    counts in both."""
    agg = status.agg(F.count(F.lit(1)).alias("assigned"),
                     *[F.count_if(F.col("status") == F.lit(g)).alias(f"stable_{g.lower()}") for g in dims.GROUPS],
                     F.count_if("is_conflict").alias("conflicts"),
                     F.count_if("is_fallback").alias("fallbacks"))
    share = F.try_divide(F.col("fallbacks"), F.col("assigned"))
    return agg.select("*", F.round(share, 6).alias("fallback_share"),
                      (F.coalesce(share, F.lit(0.0)) > F.lit(dims.FALLBACK_SHARE_MAX)).alias("fallback_alert"),
                      (F.col("conflicts") > F.lit(dims.CONFLICT_MAX)).alias("conflict_alert"))
