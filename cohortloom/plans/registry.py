"""Registered jobs over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the DuckDB twin in ``cohortloom.plans.oracle``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import dims
from cohortloom.operators import alerts, bitmaps, experiment, feedback, funnel, links, payments, reshape, signup, workflow
from cohortloom.sources import events as S
from cohortloom.session import shared_folder
from cohortloom.sources import fixtures as FX
from cohortloom.sources import bucketed, restate, shards
from cohortloom.streaming import intake, monitor

Job = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Job] = {}


def register(name: str):
    """Register a job. Dates and devices are UTC by definition, and the
    test tables' timestamps carry no zone, so each job pins the session
    time zone before it builds its plan (the caller's session may not)."""
    def deco(fn: Job) -> Job:
        @functools.wraps(fn)
        def job(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        REGISTRY[name] = job
        return fn
    return deco


# ---------------------------------------------------------------- R-1
def _signup_inputs(spark: SparkSession, sf_dir: str):
    daily = FX.daily_events(spark, sf_dir)
    intraday = FX.intraday_events(spark, sf_dir)
    # the test tables have no catalog: the landed days are those in the daily part
    cut = S.landed_max_column(daily)
    return daily, intraday, cut


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily, intraday, cut = _signup_inputs(spark, sf_dir)
    return S.union_events(daily, intraday, FX.START_DATE, cut, FX.AS_OF,
                          [dims.FIRST_OPEN, dims.SIGNUP_RESULT])


def signup_report(spark: SparkSession, sf_dir: str, ordered: bool = True) -> DataFrame:
    daily, intraday, cut = _signup_inputs(spark, sf_dir)
    return signup.signup_country_method_daily(daily, intraday, FX.START_DATE, cut, FX.AS_OF,
                                              ordered=ordered)


def report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-1 report as the input of the hand-over jobs."""
    return signup_report(spark, sf_dir, ordered=False)


@register("signup_daily")
def q_signup_daily(spark, sf_dir):
    return signup_report(spark, sf_dir)


@register("event_union")
def q_event_union(spark, sf_dir):
    return (_union(spark, sf_dir).groupBy("event_date", "event_name")
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.count_distinct("user_pseudo_id").alias("n_devices")))


@register("landed_max")
def q_landed_max(spark, sf_dir):
    daily = FX.daily_events(spark, sf_dir)
    return (daily.where(F.col(schemas.SUFFIX).rlike(r"^[0-9]{8}$"))
            .agg(F.max(schemas.SUFFIX).alias("landed_max")))


@register("first_open")
def q_first_open(spark, sf_dir):
    return signup.first_open(_union(spark, sf_dir))


@register("signup_shaped")
def q_signup_shaped(spark, sf_dir):
    return signup.signup_shaped(_union(spark, sf_dir))


@register("signup_first")
def q_signup_first(spark, sf_dir):
    return signup.signup_first(_union(spark, sf_dir))


# ---------------------------------------------------------------- R-1 from day shards (SRC-1..3, SNK-4, SM-2)
@register("shard_report")
def q_shard_report(spark, sf_dir):
    """R-1 from day folders, cut at the last landed day of the listing."""
    daily, intraday = FX.shard_folders(spark, sf_dir)
    cut = S.landed_max(spark, base=daily)
    return signup.signup_country_method_daily(S.read_shards(spark, daily), S.read_shards(spark, intraday), FX.START_DATE,
                                              cut, FX.AS_OF, ordered=False)


@register("landed_days")
def q_landed_days(spark, sf_dir):
    daily, _ = FX.shard_folders(spark, sf_dir)
    return shards.landed_days(spark, daily)


def _restated(spark: SparkSession, sf_dir: str):
    """A first run, late files, and a second run: state, report, and the
    days that the second run renewed of each."""
    daily, intraday = FX.shard_folders(spark, sf_dir, with_late=False)
    base = shared_folder(spark, "restated")
    state, report = f"{base}/state", f"{base}/report"
    restate.refresh_days(spark, daily, intraday, state, FX.START_DATE, FX.AS_OF)
    restate.restate_report(spark, state, report)
    FX.land_late(spark, sf_dir, daily)
    touched = restate.refresh_days(spark, daily, intraday, state, FX.START_DATE, FX.AS_OF)
    return state, report, touched, restate.restate_report(spark, state, report)


@register("restated_report")
def q_restated_report(spark, sf_dir):
    """The report after late files, and which of its days were rewritten."""
    _, report, _, days = _restated(spark, sf_dir)
    rows = spark.read.schema(schemas.SIGNUP_REPORT).parquet(report)
    return rows.withColumn("restated", F.col("cohort_date").cast("string").isin(days))


@register("restated_days")
def q_restated_days(spark, sf_dir):
    """Device rows per kept day, and which days the second run read."""
    state, _, touched, _ = _restated(spark, sf_dir)
    return restate.last_log(spark, state).select("suffix", "origin", "device_days", F.col("suffix").isin(touched).alias("renewed"))


# ---------------------------------------------------------------- streams (SM-1, SM-3, SM-4)
def _ended(*queries) -> None:
    for q in queries:
        q.awaitTermination()


@register("changeover_union")
def q_changeover_union(spark, sf_dir):
    """Events per day from the stream over intraday and landed shards; the
    last landed day comes after its intraday shard was read."""
    base = shared_folder(spark, "changeover")
    landed = FX.daily_events(spark, sf_dir)
    last = F.col(schemas.SUFFIX) >= FX.INTRADAY_FROM
    shards.write_shards(landed.where(~last), f"{base}/daily")
    shards.write_shards(FX.intraday_events(spark, sf_dir), f"{base}/intraday")

    def run():
        _ended(intake.changeover_stream(spark, f"{base}/daily", f"{base}/intraday", f"{base}/out", f"{base}/ckpt", available_now=True))
    run()
    shards.write_shards(landed.where(last), f"{base}/daily")
    run()
    return (S.read_shards(spark, f"{base}/out").groupBy("event_date", "event_name")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_pseudo_id").alias("n_devices")))


def _monitored(spark: SparkSession, sf_dir: str) -> str:
    """The monitor over the events, stopped and started again for the late ones."""
    base = shared_folder(spark, "monitor")
    raw = FX.raw_folder(spark, sf_dir, late=False)
    for late in (False, True):
        if late:
            FX.raw_folder(spark, sf_dir, True, raw)
        _ended(monitor.zero_monitor_stream(spark, raw, f"{base}/store", f"{base}/ckpt", FX.ALERT_START, available_now=True))
    return f"{base}/store"


@register("monitor_counts")
def q_monitor_counts(spark, sf_dir):
    return monitor.key_counts(spark, _monitored(spark, sf_dir))


@register("monitor_zero_runs")
def q_monitor_zero_runs(spark, sf_dir):
    return monitor.zero_alerts(spark, _monitored(spark, sf_dir))


@register("feedback_intake")
def q_feedback_intake(spark, sf_dir):
    """Records per outcome of the intake stream over JSON lines."""
    base = shared_folder(spark, "intake")
    _ended(*intake.feedback_intake_stream(spark, FX.feedback_lines(spark, sf_dir), f"{base}/accepted", f"{base}/rejected",
                                          f"{base}/ckpt", available_now=True))
    accepted = spark.read.parquet(f"{base}/accepted").select("demo", F.lit("accepted").alias("outcome"), F.lit(0).alias("bad"))
    rejected = spark.read.parquet(f"{base}/rejected").select("demo", F.col("reason").alias("outcome"), F.col("line").isNotNull().cast("int").alias("bad"))
    # a cut-off line has lost some of its fields, its demo among them
    demo = F.when(F.col("outcome") != "not_json", F.col("demo").cast("string")).alias("demo")
    return (accepted.unionByName(rejected).groupBy("outcome", demo)
            .agg(F.count(F.lit(1)).alias("records"), F.sum("bad").alias("bad_lines")))


# ---------------------------------------------------------------- R-2, R-3
METHOD_START = "2024-01-10"


@register("method_matrix_tall")
def q_method_matrix_tall(spark, sf_dir):
    return reshape.method_matrix_tall(report_table(spark, sf_dir), METHOD_START)


@register("method_matrix_array")
def q_method_matrix_array(spark, sf_dir):
    return reshape.method_matrix_array(report_table(spark, sf_dir), METHOD_START)


@register("daily_totals")
def q_daily_totals(spark, sf_dir):
    return reshape.daily_totals(report_table(spark, sf_dir))


@register("payload_json")
def q_payload_json(spark, sf_dir):
    return reshape.payloads(report_table(spark, sf_dir), METHOD_START)


# ---------------------------------------------------------------- R-4 .. R-6
def assignment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    assign = experiment.assignment_events(FX.app_events(spark, sf_dir), cutoff=FX.ASSIGN_CUTOFF)
    return experiment.assignment_status(assign, FX.ASSIGN_START, FX.ASSIGN_CUTOFF)


def funnel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = FX.app_events(spark, sf_dir)
    status = experiment.assignment_status(experiment.assignment_events(ev, cutoff=FX.ASSIGN_CUTOFF), FX.ASSIGN_START, FX.ASSIGN_CUTOFF)
    devices = funnel.device_funnel(experiment.stable_devices(status), funnel.step_masks(ev, cutoff=FX.ASSIGN_CUTOFF))
    return funnel.funnel_reach(devices, tabs=funnel.COUNTRY_TABS)


@register("assignment_status")
def q_assignment_status(spark, sf_dir):
    return assignment_table(spark, sf_dir)


@register("health_counts")
def q_health_counts(spark, sf_dir):
    return experiment.health_counts(assignment_table(spark, sf_dir))


@register("funnel_reach")
def q_funnel_reach(spark, sf_dir):
    return funnel_table(spark, sf_dir)


def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, devices = _devices(spark, sf_dir)
    return funnel.funnel_metrics(funnel.funnel_reach(devices, tabs=funnel.COUNTRY_TABS), FX.FIXTURE_GAPS, devices=devices)


@register("funnel_metrics")
def q_funnel_metrics(spark, sf_dir):
    m = metrics_table(spark, sf_dir)
    # null at step 1 (no previous step); as double the view reads the same in any client
    return m.withColumn("prev_reached", F.col("prev_reached").cast("double")) \
            .withColumn("step_loss", F.col("step_loss").cast("double"))


@register("input_reach")
def q_input_reach(spark, sf_dir):
    stable = experiment.stable_devices(assignment_table(spark, sf_dir))
    return funnel.input_reach(FX.screen_events(spark, sf_dir), stable, FX.SCREEN_EVENTS, cutoff=FX.ASSIGN_CUTOFF)


# ---------------------------------------------------------------- tables dealt by device, mergeable counts
BUCKETS = 8


def _bucketed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    base = shared_folder(spark, "bucketed")
    return bucketed.device_tables(spark, FX.app_events(spark, sf_dir), FX.orders_prod(spark, sf_dir), base,
                                  "b" + base.rsplit("-", 1)[1], BUCKETS, FX.ASSIGN_CUTOFF)


@register("bucketed_funnel")
def q_bucketed_funnel(spark, sf_dir):
    t = _bucketed(spark, sf_dir)
    stable = experiment.stable_devices(experiment.assignment_status(t["assign"], FX.ASSIGN_START, FX.ASSIGN_CUTOFF))
    return funnel.funnel_reach(funnel.device_funnel(stable, t["masks"]), tabs=funnel.COUNTRY_TABS)


@register("bucketed_orders")
def q_bucketed_orders(spark, sf_dir):
    t = _bucketed(spark, sf_dir)
    stable = experiment.stable_devices(experiment.assignment_status(t["assign"], FX.ASSIGN_START, FX.ASSIGN_CUTOFF))
    return _money_as_double(payments.device_orders(stable, t["orders"], FX.ASSIGN_CUTOFF), "revenue_7d", "revenue")


@register("window_orders")
def q_window_orders(spark, sf_dir):
    stable = experiment.stable_devices(assignment_table(spark, sf_dir))
    return _money_as_double(payments.window_orders(stable, FX.orders_prod(spark, sf_dir), FX.ASSIGN_CUTOFF), "revenue_7d")


@register("bitmap_reach")
def q_bitmap_reach(spark, sf_dir):
    """Distinct devices per event and version from day bitmaps, of which
    some were built again for late events."""
    state = shared_folder(spark, "bitmaps")
    ev = FX.app_events(spark, sf_dir).withColumn("app_version", F.col("app_info.version"))
    keys = ["event_name", "app_version"]
    on_time = ev.where(~FX.late_event())
    days = [r[0] for r in on_time.select(schemas.SUFFIX).distinct().collect()]      # a name a day
    bitmaps.restate_days(on_time, state, keys, days)
    bitmaps.restate_days(ev, state, keys, FX.LATE_DAYS)
    return bitmaps.distinct_devices(bitmaps.read_bitmaps(spark, state), keys)


# ---------------------------------------------------------------- R-7, R-8
def _devices(spark: SparkSession, sf_dir: str):
    """Assignment status and funnel devices."""
    ev = FX.app_events(spark, sf_dir)
    status = experiment.assignment_status(experiment.assignment_events(ev, cutoff=FX.ASSIGN_CUTOFF), FX.ASSIGN_START, FX.ASSIGN_CUTOFF)
    masks = funnel.step_masks(ev, cutoff=FX.ASSIGN_CUTOFF)
    return status, funnel.device_funnel(experiment.stable_devices(status), masks)


@register("hourly_counts")
def q_hourly_counts(spark, sf_dir):
    return alerts.hourly_counts(FX.app_events(spark, sf_dir), start=FX.ALERT_START, end=FX.ALERT_END)


@register("zero_runs")
def q_zero_runs(spark, sf_dir):
    return alerts.zero_runs(FX.app_events(spark, sf_dir), FX.ALERT_START, FX.ALERT_END)


@register("version_drop")
def q_version_drop(spark, sf_dir):
    _, devices = _devices(spark, sf_dir)
    return alerts.version_drop(alerts.reach_by_version(devices))


@register("event_completeness")
def q_event_completeness(spark, sf_dir):
    _, devices = _devices(spark, sf_dir)
    return alerts.event_completeness(alerts.reach_by_version(devices), gaps=FX.FIXTURE_GAPS)


def orders_table(spark: SparkSession, sf_dir: str, status: DataFrame | None = None) -> DataFrame:
    """Per-device orders."""
    if status is None:
        status = assignment_table(spark, sf_dir)
    return payments.device_orders(experiment.stable_devices(status), FX.orders_prod(spark, sf_dir),
                                  FX.ASSIGN_CUTOFF)


def _money_as_double(df: DataFrame, *cols: str) -> DataFrame:
    """Registered views present money as double (exact cast of the decimal
    sums), which reads the same from Spark and DuckDB in any client."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


@register("orders_7d")
def q_orders_7d(spark, sf_dir):
    return _money_as_double(orders_table(spark, sf_dir), "revenue_7d", "revenue")


@register("mature_rate")
def q_mature_rate(spark, sf_dir):
    return payments.mature_rate(orders_table(spark, sf_dir))


@register("order_totals")
def q_order_totals(spark, sf_dir):
    return _money_as_double(payments.order_totals(orders_table(spark, sf_dir)), "revenue")


@register("verdict_state")
def q_verdict_state(spark, sf_dir):
    status, devices = _devices(spark, sf_dir)
    gaps = FX.FIXTURE_GAPS
    metrics = funnel.funnel_metrics(funnel.funnel_reach(devices, tabs=funnel.COUNTRY_TABS), gaps)
    completeness = alerts.event_completeness(alerts.reach_by_version(devices), gaps=gaps)
    return payments.verdict_state(metrics, completeness, orders_table(spark, sf_dir, status))


# ---------------------------------------------------------------- R-9, R-10
@register("feedback_accepted")
def q_feedback_accepted(spark, sf_dir):
    acc = feedback.feedback_accepted(FX.feedback_records(spark, sf_dir))
    return acc.select("doc_id", "name", "text", F.size("images").cast("bigint").alias("n_images"),
                      F.to_json("images").alias("images_json"), "context", "page", "demo")


@register("feedback_rejected")
def q_feedback_rejected(spark, sf_dir):
    rej = feedback.feedback_rejected(FX.feedback_records(spark, sf_dir))
    return rej.select("doc_id", "name", F.length("text").cast("bigint").alias("text_chars"),
                      F.size("images").cast("bigint").alias("n_images"), "page", "reason")


@register("page_clean")
def q_page_clean(spark, sf_dir):
    checked = feedback.checked_feedback(FX.feedback_records(spark, sf_dir))
    return checked.groupBy("page").agg(F.count(F.lit(1)).alias("records"),
                                       F.count_if("accepted").alias("accepted"))


@register("feedback_routes")
def q_feedback_routes(spark, sf_dir):
    return feedback.feedback_routes(FX.feedback_triage(spark, sf_dir), FX.pool_table(spark, sf_dir),
                                    FX.release_table(spark, sf_dir))


@register("transcript_lines")
def q_transcript_lines(spark, sf_dir):
    return feedback.transcript_lines(FX.speech_segments(spark, sf_dir))


@register("transcript")
def q_transcript(spark, sf_dir):
    return feedback.transcript(FX.speech_segments(spark, sf_dir))


# ---------------------------------------------------------------- R-11 .. R-14
RELEASE_VERSION = "1.3.0"


@register("pool_to_release")
def q_pool_to_release(spark, sf_dir):
    # the execution fields are empty at hand-over; the view leaves them out
    return workflow.pool_to_release(workflow.pool_clean(FX.pool_table(spark, sf_dir))).drop(*workflow.EXECUTION_FIELDS)


@register("handoff_missing")
def q_handoff_missing(spark, sf_dir):
    return workflow.handoff_missing(FX.pool_table(spark, sf_dir), FX.release_table(spark, sf_dir))


@register("version_mismatch")
def q_version_mismatch(spark, sf_dir):
    return workflow.version_mismatch(FX.pool_table(spark, sf_dir), FX.release_table(spark, sf_dir))


@register("not_closed")
def q_not_closed(spark, sf_dir):
    return workflow.not_closed(FX.pool_table(spark, sf_dir), FX.release_table(spark, sf_dir))


@register("dependency_check")
def q_dependency_check(spark, sf_dir):
    return workflow.dependency_check(FX.pool_table(spark, sf_dir))


@register("link_ends")
def q_link_ends(spark, sf_dir):
    ends = links.link_ends(FX.linked_pool(spark, sf_dir))
    return ends.withColumn("depth", F.col("depth").cast("double"))


@register("ship_groups")
def q_ship_groups(spark, sf_dir):
    g = links.ship_groups(FX.linked_pool(spark, sf_dir))
    # null in a group of a cycle alone; as double the view reads the same in any client
    return g.withColumn("longest_chain", F.col("longest_chain").cast("double"))


@register("release_table")
def q_release_table(spark, sf_dir):
    """The release table from its four sources; the view shows the fields
    that every source fills, and how many execution fields are filled."""
    filled = sum(F.col(c).isNotNull().cast("int") for c in workflow.EXECUTION_FIELDS)
    return FX.release_table(spark, sf_dir).select("id", "name", "module", "type", "priority", "app_version", "requester",
                                                  "status", "product", filled.cast("bigint").alias("filled"))


@register("pool_list_product")
def q_pool_list_product(spark, sf_dir):
    return workflow.pool_list(FX.pool_table(spark, sf_dir), dims.APP_PRODUCT)


@register("release_missing_fields")
def q_release_missing_fields(spark, sf_dir):
    return workflow.release_missing_fields(FX.release_table(spark, sf_dir))


@register("release_list")
def q_release_list(spark, sf_dir):
    return workflow.release_list(FX.release_table(spark, sf_dir), RELEASE_VERSION)


@register("release_list_product")
def q_release_list_product(spark, sf_dir):
    return workflow.release_list(FX.release_table(spark, sf_dir), RELEASE_VERSION, dims.APP_PRODUCT)


@register("release_by_type")
def q_release_by_type(spark, sf_dir):
    return workflow.release_by_type(FX.release_table(spark, sf_dir))


@register("status_audit")
def q_status_audit(spark, sf_dir):
    return workflow.status_audit(FX.status_log(spark, sf_dir))


@register("triage_counts")
def q_triage_counts(spark, sf_dir):
    return (feedback.route_checks(FX.feedback_triage(spark, sf_dir))
            .groupBy("destination").agg(F.count(F.lit(1)).alias("records"),
                                        F.count_if("missing_link").alias("missing_link")))


@register("feedback_missing_fields")
def q_feedback_missing_fields(spark, sf_dir):
    return (feedback.feedback_missing_fields(FX.feedback_records(spark, sf_dir))
            .select("doc_id", "missing"))


# ---------------------------------------------------------------- further keys of the build plan
@register("country_map")
def q_country_map(spark, sf_dir):
    """The report's country map applied to first opens: devices per
    (country name, code)."""
    return (signup.first_open(_union(spark, sf_dir))
            .groupBy("country", "country_code").agg(F.count(F.lit(1)).alias("devices")))


@register("rate")
def q_rate(spark, sf_dir):
    return signup_report(spark, sf_dir, ordered=False).select(
        "cohort_date", "country_code", "first_opens", "registered", "registered_rate")


@register("first_country")
def q_first_country(spark, sf_dir):
    return experiment.stable_devices(assignment_table(spark, sf_dir)).select(
        "user_pseudo_id", "grp", "stable_ts", "country", "country_code")


@register("fallback_share")
def q_fallback_share(spark, sf_dir):
    return experiment.health_counts(assignment_table(spark, sf_dir)).select(
        "assigned", "fallbacks", "fallback_share", "fallback_alert")


@register("funnel_by_country")
def q_funnel_by_country(spark, sf_dir):
    return funnel.funnel_by_country(funnel_table(spark, sf_dir))


@register("country_tab")
def q_country_tab(spark, sf_dir):
    return funnel.country_tab(funnel_table(spark, sf_dir), "KR")


@register("lesson_reach")
def q_lesson_reach(spark, sf_dir):
    status = assignment_table(spark, sf_dir)
    return funnel.lesson_reach(FX.app_events(spark, sf_dir), experiment.stable_devices(status), cutoff=FX.ASSIGN_CUTOFF)


@register("gap_flagged")
def q_gap_flagged(spark, sf_dir):
    return metrics_table(spark, sf_dir).where(F.col("is_known_gap")).select("grp", "country_code", "step_no", "step", "reached", "step_rate")
