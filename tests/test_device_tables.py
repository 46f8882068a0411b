"""Tables dealt by device, range joins by day, mergeable distinct counts,
pruned scans, known gaps by version."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import dims
from cohortloom.operators import alerts, bitmaps, experiment, funnel, payments
from cohortloom.plans.registry import _bucketed
from cohortloom.sources import bucketed, shards
from cohortloom.sources import events as S
from cohortloom.sources import fixtures as FX
from tests.event_rows import ev, events_df, micros, p

SF = "/root/testdata/sf0.001"
START, CUT = "2024-01-02 06:00", "2024-01-04 12:00"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", bucketed.CO_PARTITION[0])}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_no_exchange_on_the_device(spark, no_broadcast):
    t = _bucketed(spark, SF)
    status = experiment.assignment_status(t["assign"], FX.ASSIGN_START, FX.ASSIGN_CUTOFF)
    stable = experiment.stable_devices(status)
    devices = funnel.device_funnel(stable, t["masks"])
    orders = payments.device_orders(stable, t["orders"], FX.ASSIGN_CUTOFF)
    for df in (status, devices, orders):
        assert "hashpartitioning(user_pseudo_id" not in physical(df) and "Exchange" not in physical(df)
    # the same jobs over the events shuffle on the device
    plain = experiment.assignment_status(experiment.assignment_events(FX.app_events(spark, SF)), FX.ASSIGN_START, FX.ASSIGN_CUTOFF)
    assert "hashpartitioning(user_pseudo_id" in physical(plain)
    assert sorted(map(tuple, status.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_window_orders_equal_the_residual_form(spark):
    day = payments.DAY_MICROS
    t0 = 10 * day + 5 * 3_600_000_000
    stable = spark.createDataFrame([("hot", "A", "VN", t0), ("edge", "B", "KR", 9 * day), ("none", "A", "VN", t0)],
                                   "user_pseudo_id string, grp string, country_code string, first_ts long")
    hot = spark.range(20_000).select(F.lit("hot").alias("user_pseudo_id"), "id", (F.lit(9 * day) + F.col("id") * (day // 1000)).alias("order_ts"),
                                     F.when(F.col("id") % 3 == 0, "FAILED").otherwise("SUCCESS").alias("status"), F.lit("1.25").cast("decimal(18,2)").alias("amount"))
    edge = spark.createDataFrame([("edge", 1, 9 * day), ("edge", 2, 16 * day - 1), ("edge", 3, 16 * day), ("edge", 4, 9 * day - 1), ("other", 5, t0)],
                                 "user_pseudo_id string, id long, order_ts long").withColumns(
                                     {"status": F.lit("SUCCESS"), "amount": F.lit("2").cast("decimal(18,2)")})
    orders = hot.unionByName(edge)
    whole = payments.device_orders(stable, orders, 30 * day).select("user_pseudo_id", "orders_7d", "revenue_7d")
    cells = payments.window_orders(stable, orders, 30 * day)
    assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, whole.collect()))
    assert {r[0]: r[1] for r in cells.collect()}["edge"] == 2
    plan = physical(cells)
    assert "day" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def state_files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_bitmaps_of_a_restated_day(spark, scratch):
    def rows(days):
        return [ev("first_open" if u % 3 else "lesson_event", f"2024-01-{d:02d}", "10:00", None if u == 7 else f"u{u}", event_id=d * 1000 + u)
                for d, users in days.items() for u in users]

    days = {2: range(0, 40), 3: range(20, 60), 4: range(0, 10)}
    first = events_df(spark, rows(days))
    names = [f"2024010{d}" for d in days]
    bitmaps.restate_days(first, scratch, ["event_name"], names)
    before = state_files(scratch + "/bitmaps")
    # the third lands again, with late and new devices and without some of the old ones
    days[3] = range(30, 90)
    again = events_df(spark, rows(days))
    bitmaps.restate_days(again, scratch, ["event_name"], ["20240103"])
    held = bitmaps.read_bitmaps(spark, scratch)

    def exact(df, keys):
        return sorted(map(tuple, df.groupBy(*keys).agg(F.count_distinct("user_pseudo_id")).collect()))

    for keys in (["event_name"], [schemas.SUFFIX], [schemas.SUFFIX, "event_name"], []):
        assert sorted(map(tuple, bitmaps.distinct_devices(held, keys).collect())) == exact(again, keys)
    two = F.col(schemas.SUFFIX) >= "20240103"
    assert sorted(map(tuple, bitmaps.distinct_devices(held.where(two), ["event_name"]).collect())) == exact(again.where(two), ["event_name"])
    after = state_files(scratch + "/bitmaps")
    untouched = {f: t for f, t in before.items() if "suffix=20240103" not in f}
    assert untouched.items() <= after.items() and {f for f in after if "20240103" in f}.isdisjoint(before)
    numbers = bitmaps.known_devices(spark, scratch + "/devices")
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("user_pseudo_id").distinct().count() == 89
    bitmaps.restate_days(again.where(~two), scratch, ["event_name"], ["20240104"])    # a day that lost all its events
    assert "20240104" not in {r[0] for r in bitmaps.read_bitmaps(spark, scratch).select(schemas.SUFFIX).collect()}


@pytest.fixture()
def shard_events(spark, scratch):
    rows = [ev(name, f"2024-01-{d:02d}", f"{h:02d}:30", f"u{d}", (p("experiment", dims.EXPERIMENT), p("group", "A")), event_id=d * 100 + h)
            for d in range(1, 9) for h in (3, 15) for name in (dims.ASSIGN_EVENT, dims.FIRST_OPEN)]
    shards.write_shards(events_df(spark, rows), scratch + "/shards")
    return S.read_shards(spark, scratch + "/shards")


def test_scans_are_bounded_by_day(spark, shard_events):
    assign = experiment.assignment_events(shard_events, cutoff=CUT, since="2024-01-02")
    jobs = {"assignment_status": experiment.assignment_status(assign, START, CUT), "zero_runs": alerts.zero_runs(shard_events, START, CUT),
            "hourly_counts": alerts.hourly_counts(shard_events, start=START, end=CUT)}
    for name, df in jobs.items():
        filters = [x.split("PartitionFilters: [")[1].split("]")[0] for x in physical(df).split("\n") if "PartitionFilters: [" in x]
        assert filters, name
        for f in filters:
            assert ">= 20240102" in f and "<= 20240104" in f, name
        df.collect()
    whole = experiment.assignment_status(experiment.assignment_events(shard_events.where("suffix >= '20240102'")), START, CUT)
    assert sorted(map(tuple, jobs["assignment_status"].collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    hours = jobs["hourly_counts"].agg(F.min("hour"), F.max("hour")).first()
    assert hours[0] >= micros("2024-01-02", "06:00") // alerts.HOUR_MICROS and hours[1] < micros("2024-01-04", "12:00") // alerts.HOUR_MICROS


def test_known_gap_marks_rows_with_devices_of_its_version(spark):
    rows = [("u1", "B", "KR", "1.4.2", 0b1110), ("u2", "B", "VN", "1.5.0", 0b0010), ("u3", "A", "KR", "1.4.2", 0b0010), ("u4", "B", "KR", "1.5.0", 0)]
    devices = spark.createDataFrame(rows, "user_pseudo_id string, grp string, country_code string, app_version string, mask long")
    gaps = [("B", "1.4.2", "lesson_start")]
    m = funnel.funnel_metrics(funnel.funnel_reach(devices), gaps, devices=devices).where("is_known_gap")
    assert {(r["grp"], r["country_code"], r["step"], r["gap_devices"]) for r in m.collect()} == {
        ("B", "KR", "lesson_start", 1), ("B", "ALL", "lesson_start", 1)}
    by_version = funnel.funnel_metrics(funnel.funnel_reach(devices, by=("app_version",), with_all=False), gaps, by="app_version")
    assert {(r["grp"], r["app_version"], r["step"]) for r in by_version.where("is_known_gap").collect()} == {("B", "1.4.2", "lesson_start")}


def test_input_metrics_take_their_events_from_the_caller():
    names = [r[2] for r in funnel.input_steps({"lesson_finish": "done", "paywall_2": "pw2"}) if r[0] == "A"]
    assert names == ["signup", "lesson_start", "lesson_finish", "paywall_2", "checkout_start"]
    with pytest.raises(ValueError):
        funnel.input_steps({"other": "x"})
