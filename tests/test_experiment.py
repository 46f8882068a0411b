"""R-4 .. R-8 edge rows: assignment, funnel, flags, alerts, payments."""

from __future__ import annotations

import decimal

import pytest
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.operators import alerts, experiment, funnel, payments
from tests.event_rows import ev, events_df, micros, p

START, CUTOFF = "2024-01-01 00:00:00", "2024-01-20 00:00:00"


def assign(user, grp, day="2024-01-05", hhmm="10:00", country="Vietnam", version="1.4.0", event_id=None):
    return ev("experiment_group_assign", day, hhmm, user, params=[p("experiment", "conv_funnel_v1"), p("group", grp)],
              country=country, version=version, event_id=event_id)


def status_of(spark, rows, **kw):
    a = experiment.assignment_events(events_df(spark, rows))
    return {r["user_pseudo_id"]: r.asDict() for r in experiment.assignment_status(a, START, CUTOFF, **kw).collect()}


def test_status_rules(spark):
    rows = [assign("s", "A"), assign("s", "A", hhmm="11:00"),
            assign("c", "A"), assign("c", "B", hhmm="11:00"),
            assign("f", "A"), assign("f", "fallback", hhmm="11:00"),
            assign("fc", "A"), assign("fc", "B"), assign("fc", "fallback"),
            assign("k", "B", country="Vietnam"), assign("k", "B", day="2024-01-06", country="Thailand")]
    st = status_of(spark, rows)
    assert st["s"]["status"] == "A" and st["s"]["grp"] == "A"
    assert st["c"]["status"] == "conflict" and st["c"]["grp"] is None
    assert st["f"]["status"] == "fallback" and st["fc"]["status"] == "fallback" and st["fc"]["is_conflict"]
    assert st["k"]["country_code"] == "VN"


def test_window_is_on_first_assignment_and_cutoff_is_exclusive(spark):
    rows = [assign("early", "A", day="2023-12-31"), assign("early", "A", day="2024-01-02"),
            assign("late", "B", day="2024-01-20", hhmm="00:00"),
            assign("edge", "A", day="2024-01-19", hhmm="23:59"), assign("edge", "B", day="2024-01-20")]
    st = status_of(spark, rows)
    assert "early" not in st and "late" not in st
    assert st["edge"]["status"] == "A"          # the B after the cutoff is ignored


def test_platform_filter(spark):
    rows = [assign("a", "A"), ev("experiment_group_assign", "2024-01-05", "10:00", "i",
                                 params=[p("experiment", "conv_funnel_v1"), p("group", "A")], platform="IOS")]
    assert set(status_of(spark, rows)) == {"a"}
    assert set(status_of(spark, rows, platform=None)) == {"a", "i"}


def funnel_rows(spark, rows, steps=None):
    evs = events_df(spark, rows)
    st = funnel.steps_frame(spark, steps)
    status = experiment.assignment_status(experiment.assignment_events(evs), START, CUTOFF)
    devices = funnel.device_funnel(experiment.stable_devices(status), funnel.step_masks(evs, st))
    return funnel.funnel_reach(devices, st), devices, st


def test_order_free_cumulative_funnel(spark):
    ok = [p("is_success", "true")]
    rows = [assign("x", "A"), ev("first_open", "2024-01-05", "09:00", "x"),
            ev("lesson_event", "2024-01-05", "09:30", "x", params=[p("lesson_id", None, 732)]),   # step 3 w/o 2
            assign("y", "A"),
            ev("subscription_checkout_start", "2024-01-05", "08:00", "y"),                        # reverse time
            ev("lesson_event", "2024-01-05", "08:10", "y", params=[p("lesson_id", None, 1615)]),
            ev("signup_result", "2024-01-05", "08:20", "y", params=ok),
            ev("first_open", "2024-01-05", "08:30", "y"),
            assign("z", "A"),                                                                       # no events
            assign("w", "B"), ev("first_open", "2024-01-05", "09:00", "w"),
            ev("signup_result", "2024-01-05", "09:10", "w", params=ok),
            ev("lesson_event", "2024-01-05", "09:20", "w", params=[p("lesson_id", None, 732)])]    # A lesson
    reach, _, _ = funnel_rows(spark, rows)
    got = {(r["grp"], r["country_code"], r["step_no"]): (r["assigned"], r["reached"], r["hit"]) for r in reach.collect()}
    assert [got[("A", "VN", k)] for k in (1, 2, 3, 4)] == [(3, 2, 2), (3, 1, 1), (3, 1, 2), (3, 1, 1)]
    assert got[("B", "VN", 3)] == (1, 0, 0) and got[("B", "ALL", 2)] == (1, 1, 1)


def test_all_row_is_not_sum_of_tabs(spark):
    rows = [assign("a", "A", country="Vietnam"), ev("first_open", "2024-01-05", "09:00", "a"),
            assign("b", "A", country="France"), ev("first_open", "2024-01-05", "09:00", "b"),
            assign("c", "A", country=None), ev("first_open", "2024-01-05", "09:00", "c")]
    reach, _, _ = funnel_rows(spark, rows)
    r = {(x["country_code"], x["step_no"]): x["reached"] for x in reach.collect() if x["grp"] == "A"}
    assert r[("ALL", 1)] == 3 and r[("VN", 1)] == 1 and r[("Other", 1)] == 2


def test_small_sample_flags_both_groups(spark):
    reach_rows = [("A", "VN", 1, "first_open", 40, 29, 29), ("B", "VN", 1, "first_open", 40, 35, 35),
                  ("A", "KR", 1, "first_open", 40, 30, 30), ("B", "KR", 1, "first_open", 40, 31, 31),
                  ("A", "MY", 1, "first_open", 40, 90, 90)]
    reach = spark.createDataFrame(reach_rows, "grp string, country_code string, step_no int, step string, "
                                              "assigned bigint, reached bigint, hit bigint")
    m = {(r["grp"], r["country_code"]): r["small_sample"]
         for r in funnel.funnel_metrics(reach, funnel.gaps_frame(spark, [])).collect()}
    assert m[("A", "VN")] and m[("B", "VN")]
    assert not m[("A", "KR")] and not m[("B", "KR")]
    assert m[("A", "MY")]            # B absent counts as 0


def test_every_tab_has_a_row_per_group(spark):
    devices = spark.createDataFrame([("u", "A", "VN", "1.0", 2), ("v", "B", "JP", "1.0", 0)],
                                    "user_pseudo_id string, grp string, country_code string, app_version string, mask bigint")
    reach = funnel.funnel_reach(devices, tabs=funnel.COUNTRY_TABS)
    got = {(r["grp"], r["country_code"], r["step_no"]): (r["assigned"], r["reached"]) for r in reach.collect()}
    for g in "AB":
        for tab in funnel.COUNTRY_TABS:
            assert {n for gg, c, n in got if (gg, c) == (g, tab)} == {1, 2, 3, 4}
    assert got[("A", "VN", 1)] == (1, 1) and got[("B", "VN", 1)] == (0, 0) and got[("B", "ALL", 1)] == (1, 0)
    assert got[("B", "JP", 1)] == (1, 0) and ("A", "JP", 1) not in got
    metrics = {(r["grp"], r["country_code"], r["step_no"]): r for r in funnel.funnel_metrics(reach).collect()}
    assert metrics[("B", "KR", 2)]["step_rate"] is None and metrics[("B", "KR", 1)]["small_sample"]
    assert funnel.country_tab(reach, "KR").count() == 8


def test_screens_become_steps_that_known_gaps_match(spark):
    steps = funnel.default_steps({"study_plan": "study_plan_view", "paywall_1": "paywall_view"})
    assert [s[2] for s in steps if s[0] == "B"] == ["first_open", "signup", "study_plan", "paywall_1", "lesson_start", "checkout_start"]
    assert [s[2] for s in steps if s[0] == "A"] == ["first_open", "signup", "lesson_start", "checkout_start"]
    assert [s[1] for s in steps if s[0] == "B"] == [1, 2, 3, 4, 5, 6]
    assert [s[2] for s in funnel.default_steps({"paywall_1": "x"}) if s[0] == "B"][2] == "paywall_1"
    with pytest.raises(ValueError):
        funnel.default_steps({"paywall_9": "x"})
    rows = [assign("b", "B"), ev("first_open", "2024-01-05", "11:00", "b"), ev("study_plan_view", "2024-01-05", "12:00", "b")]
    reach, _, _ = funnel_rows(spark, rows, steps)
    flagged = {r["step"] for r in funnel.funnel_metrics(reach).where("is_known_gap").collect()}
    assert flagged == {"study_plan", "paywall_1"}


def test_step_rates_and_gap_flag(spark):
    rows = [("B", "ALL", 1, "first_open", 10, 10, 10), ("B", "ALL", 2, "study_plan", 10, 5, 6),
            ("B", "ALL", 3, "paywall_1", 10, 0, 1)]
    reach = spark.createDataFrame(rows, "grp string, country_code string, step_no int, step string, "
                                        "assigned bigint, reached bigint, hit bigint")
    m = {r["step_no"]: r for r in funnel.funnel_metrics(reach, funnel.gaps_frame(spark)).collect()}
    assert m[1]["step_rate"] is None and m[2]["step_rate"] == 0.5 and m[3]["step_rate"] == 0.0
    assert m[2]["start_rate"] == 0.5 and m[2]["step_loss"] == 5
    assert m[2]["is_known_gap"] and m[3]["is_known_gap"] and not m[1]["is_known_gap"]


@pytest.mark.parametrize("hours,alert", [(5, False), (6, True)])
def test_zero_run_threshold(spark, hours, alert):
    rows = [ev("first_open", "2024-01-05", "00:00", "u")]
    rows += [ev("first_open", "2024-01-05", f"{h:02d}:00", "u") for h in range(1 + hours, 12)]
    out = alerts.zero_runs(events_df(spark, rows), "2024-01-05 00:00:00", "2024-01-05 12:00:00", ["first_open"], dim_values=["VN"])
    assert (out.count() == 1) == alert


@pytest.mark.parametrize("prev,cur,alert", [(1.0, 0.71, False), (1.0, 0.70, True)])
def test_version_drop_threshold(spark, prev, cur, alert):
    rows = [("A", "1.4.0", 1, "first_open", 100, 100, 100), ("A", "1.4.0", 2, "signup", 100, int(prev * 100), 1),
            ("A", "1.10.0", 1, "first_open", 100, 100, 100), ("A", "1.10.0", 2, "signup", 100, int(cur * 100), 1),
            ("A", "1.9.0", 1, "first_open", 100, 100, 100), ("A", "1.9.0", 2, "signup", 100, int(prev * 100), 1)]
    rv = spark.createDataFrame(rows, "grp string, app_version string, step_no int, step string, "
                                     "assigned bigint, reached bigint, hit bigint")
    d = {r["app_version"]: r for r in alerts.version_drop(rv).where("step_no = 2").collect()}
    assert d["1.10.0"]["prev_version"] == "1.9.0"     # numeric, not text, order
    assert d["1.10.0"]["is_drop"] == alert and not d["1.4.0"]["is_drop"]


@pytest.mark.parametrize("fallbacks,alert", [(10, False), (11, True)])
def test_fallback_share_threshold(spark, fallbacks, alert):
    rows = [(f"d{i}", "fallback" if i < fallbacks else "A") for i in range(1000)]
    st = spark.createDataFrame([(*r, r[1] == "fallback", False) for r in rows],
                               "user_pseudo_id string, status string, is_fallback boolean, is_conflict boolean")
    h = experiment.health_counts(st).first()
    assert h["fallback_alert"] == alert and not h["conflict_alert"]


def test_completeness_marks_one_version_gap(spark):
    rows = [("A", "1.4.0", 1, "first_open", 5, 5, 5), ("A", "1.4.2", 1, "first_open", 5, 5, 5),
            ("A", "1.4.0", 2, "signup", 5, 3, 3), ("A", "1.4.2", 2, "signup", 5, 0, 0)]
    rv = spark.createDataFrame(rows, "grp string, app_version string, step_no int, step string, "
                                     "assigned bigint, reached bigint, hit bigint")
    steps = spark.createDataFrame([("A", 1, "first_open", "first_open", None, False),
                                   ("A", 2, "signup", "signup_result", None, True),
                                   ("A", 3, "lesson_start", "lesson_event", None, False)], schemas.FUNNEL_STEPS)
    c = {(r["app_version"], r["step_no"]): r["is_gap"]
         for r in alerts.event_completeness(rv, steps, funnel.gaps_frame(spark, [])).collect()}
    assert c[("1.4.2", 2)] and not c[("1.4.0", 2)] and not c[("1.4.0", 3)]


def test_maturity_and_seven_day_window(spark):
    cutoff = "2024-01-20 00:00:00"
    t0 = micros("2024-01-13")
    day = 86_400_000_000
    stable = spark.createDataFrame([("m", "A", "VN", t0), ("i", "A", "VN", t0 + 1)],
                                   "user_pseudo_id string, grp string, country_code string, first_ts bigint")
    D = decimal.Decimal
    orders = spark.createDataFrame([("m", 1, t0 + 7 * day, "SUCCESS", D(5)), ("m", 2, t0 + 7 * day - 1, "FAILED", D(5)),
                                    ("i", 3, t0 + 10, "SUCCESS", D(9)), ("i", 4, t0 - 10, "SUCCESS", D(9))],
                                   schemas.ORDERS)
    d = {r["user_pseudo_id"]: r for r in payments.device_orders(stable, orders, cutoff).collect()}
    assert d["m"]["is_mature"] and not d["i"]["is_mature"]
    assert d["m"]["orders_7d"] == 0                 # exactly 7 days is outside
    assert d["i"]["orders_7d"] == 1 and d["i"]["orders"] == 1
    rate = payments.mature_rate(payments.device_orders(stable, orders, cutoff)).where("country_code = 'ALL'").first()
    assert rate["mature_devices"] == 1 and rate["paid_rate_7d"] == 0.0


def test_funnel_reach_never_rises_on_test_tables(spark):
    from cohortloom.plans.registry import funnel_table
    from pyspark.sql import Window
    df = funnel_table(spark, "/root/testdata/sf0.01")
    w = Window.partitionBy("grp", "country_code").orderBy("step_no")
    rises = df.select((F.col("reached") > F.lag("reached").over(w)).alias("up")).where("up")
    assert rises.count() == 0


def test_conflict_under_a_fallback_still_alerts(spark):
    rows = [assign("x", "A"), assign("x", "B"), assign("x", "fallback"), assign("y", "A")]
    status = experiment.assignment_status(experiment.assignment_events(events_df(spark, rows)), "2024-01-01", "2024-02-01")
    assert {r["user_pseudo_id"]: (r["status"], r["is_conflict"]) for r in status.collect()}["x"] == ("fallback", True)
    h = experiment.health_counts(status).first()
    assert (h["conflicts"], h["fallbacks"], h["conflict_alert"], h["fallback_alert"]) == (1, 1, True, True)


def test_outage_at_the_edges_and_of_a_silent_key(spark):
    rows = [ev("first_open", "2024-01-05", f"{h:02d}:30", "u") for h in range(8, 12)]
    out = alerts.zero_runs(events_df(spark, rows), "2024-01-05 00:00:00", "2024-01-06 00:00:00", ["first_open"], dim_values=["VN", "KR"])
    assert sorted((r["country_code"], r["zero_from"][-5:], r["zero_to"][-5:], r["zero_hours"]) for r in out.collect()) == [
        ("KR", "00:00", "23:00", 24), ("VN", "00:00", "07:00", 8), ("VN", "12:00", "23:00", 12)]


def test_zero_runs_of_a_callers_dimension(spark):
    rows = [ev("first_open", "2024-01-05", f"{h:02}:00", "u") for h in range(8)] + [ev("first_open", "2024-01-05", "10:00", "v")]
    out = alerts.zero_runs(events_df(spark, rows), "2024-01-05 00:00:00", "2024-01-05 12:00:00", ["first_open"], dim=F.col("user_pseudo_id"), min_hours=3)
    assert sorted((r["country_code"], r["zero_from"][-5:], r["zero_hours"]) for r in out.collect()) == [("u", "08:00", 4), ("v", "00:00", 10)]


def test_step_events_after_the_cutoff_do_not_count(spark):
    steps = [("A", 1, "open", "first_open", None, False)]
    rows = [ev("first_open", "2024-01-05", "10:00", "u"), ev("first_open", "2024-01-07", "12:00", "v")]
    masks = funnel.step_masks(events_df(spark, rows), steps, cutoff="2024-01-07 12:00:00")
    assert [r["user_pseudo_id"] for r in masks.collect()] == ["u"]


@pytest.mark.parametrize("as_frame", [False, True])
def test_gaps_in_step_numbers_and_too_many_steps(spark, as_frame):
    form = (lambda s: spark.createDataFrame(s, schemas.FUNNEL_STEPS)) if as_frame else (lambda s: s)
    steps = form([("A", n, f"s{n}", f"e{n}", None, False) for n in (1, 2, 4, 65)])
    rows = [ev(f"e{n}", "2024-01-05", "10:00", "u") for n in (1, 2, 4, 65)] + [ev("e65", "2024-01-05", "10:00", "v")]
    masks = funnel.step_masks(events_df(spark, rows), steps, event_names=["e1", "e2", "e4", "e65"])
    devices = masks.selectExpr("user_pseudo_id", "grp", "'VN' country_code", "'v' app_version", "mask")
    got = {r["step_no"]: (r["reached"], r["hit"]) for r in funnel.funnel_reach(devices, steps).where("country_code = 'VN'").collect()}
    assert got == {1: (1, 1), 2: (1, 1), 4: (1, 1), 65: (1, 2)}
    many = [("A", n, f"s{n}", "e", None, False) for n in range(1, 64)]
    with pytest.raises(Exception, match="more than 62 steps"):
        funnel.funnel_reach(devices, form(many)).collect()


def test_verdict_states(spark):
    from cohortloom.operators import payments
    metrics = spark.createDataFrame([("A", "KR", 1, True), ("A", "VN", 1, False), ("B", "VN", 1, False), ("C", "VN", 1, False)],
                                    "grp string, country_code string, step_no int, small_sample boolean")
    complete = spark.createDataFrame([("A", True, False), ("B", True, True), ("C", False, False)],
                                     "grp string, is_gap boolean, is_known_gap boolean")
    orders = spark.createDataFrame([("B", "VN", True), ("C", "VN", False)], "grp string, country_code string, is_mature boolean")
    got = {(r["grp"], r["country_code"]): r["verdict_state"] for r in payments.verdict_state(metrics, complete, orders).collect()}
    assert got == {("A", "KR"): "small_sample", ("A", "VN"): "version_gap", ("B", "VN"): "comparable", ("C", "VN"): "immature"}
