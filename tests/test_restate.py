"""Day shards from the catalog, and restatement by changed days."""

from __future__ import annotations

import os

import pytest

from cohortloom.operators import signup
from cohortloom.sources import events as S
from cohortloom.sources import restate, shards
from tests.event_rows import ev, events_df, p

START, AS_OF = "2024-01-01", "2024-01-31"
OK = (p("signup_method", "google"), p("is_success", "true"))


def files(path):
    """Data files below a folder with their change times."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def land(spark, base, rows):
    shards.write_shards(events_df(spark, rows), base)


@pytest.fixture()
def days(spark, scratch):
    """Three landed days, one of them empty, and two intraday days."""
    daily, intraday = scratch + "/daily", scratch + "/intraday"
    land(spark, daily, [ev("first_open", "2024-01-02", "10:00", "a", event_id=1),
                        ev("signup_result", "2024-01-02", "11:00", "a", OK, event_id=2),
                        ev("first_open", "2024-01-03", "10:00", "b", event_id=3),
                        ev("signup_result", "2024-01-03", "10:30", "b", OK, event_id=4),
                        ev("first_open", "2024-01-03", "10:00", "c", event_id=5),
                        ev("first_open", "2024-01-02", "01:00", "x", suffix="intraday_20240102", event_id=6)])
    shards.land_empty(spark, daily, "2024-01-04")
    land(spark, intraday, [ev("first_open", "2024-01-04", "10:00", "d", event_id=7),
                           ev("first_open", "2024-01-05", "10:00", "e", event_id=8)])
    return daily, intraday


def whole_report(spark, daily, intraday):
    cut = S.landed_max(spark, base=daily)
    return sorted(map(tuple, signup.signup_country_method_daily(
        S.read_shards(spark, daily), S.read_shards(spark, intraday), START, cut, AS_OF).collect()))


def kept_report(spark, path):
    return sorted(map(tuple, spark.read.schema(restate.schemas.SIGNUP_REPORT).parquet(path)
                      .select(*signup.REPORT_COLUMNS).collect()))


def run(spark, daily, intraday, scratch):
    touched = restate.refresh_days(spark, daily, intraday, scratch + "/state", START, AS_OF)
    return touched, restate.restate_report(spark, scratch + "/state", scratch + "/report")


def test_empty_shard_is_landed_and_days_are_pruned(spark, days):
    daily, intraday = days
    assert S.landed_max(spark, base=daily) == "20240104"
    assert [tuple(r) for r in shards.landed_days(spark, daily).orderBy("suffix").collect()] == [
        ("20240102", 2, False), ("20240103", 3, False), ("20240104", 0, True)]
    # the empty landed day hides its intraday events; the folder that is no day is not read
    assert [r[0].isoformat() for r in whole_report(spark, daily, intraday)] == ["2024-01-02", "2024-01-03", "2024-01-05"]
    for df in (S.read_daily(spark, daily, "2024-01-03", "20240104"), S.read_intraday(spark, intraday, "20240104", AS_OF)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "suffix" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_late_file_renews_its_day_only(spark, days, scratch):
    daily, intraday = days
    assert run(spark, daily, intraday, scratch) == (["20240102", "20240103", "20240105"], ["2024-01-02", "2024-01-03", "2024-01-05"])
    assert kept_report(spark, scratch + "/report") == whole_report(spark, daily, intraday)
    before = files(scratch + "/state/days"), files(scratch + "/report")
    assert run(spark, daily, intraday, scratch) == ([], [])       # nothing landed, nothing written
    assert (files(scratch + "/state/days"), files(scratch + "/report")) == before
    # c opened on the 2nd already: the late file of that day also takes c out of the 3rd
    land(spark, daily, [ev("first_open", "2024-01-02", "23:00", "c", event_id=20), ev("first_open", "2024-01-02", "23:10", "f", event_id=21)])
    assert run(spark, daily, intraday, scratch) == (["20240102"], ["2024-01-02", "2024-01-03"])
    assert kept_report(spark, scratch + "/report") == whole_report(spark, daily, intraday)
    after = files(scratch + "/state/days"), files(scratch + "/report")
    assert before[0].items() <= after[0].items()                   # kept days are never written again
    assert {f for f in after[0].keys() - before[0].keys()} == {f for f in after[0] if "run=2/suffix=20240102" in f}
    kept = {f: t for f, t in before[1].items() if "cohort_date=2024-01-05" in f}
    assert kept and kept.items() <= after[1].items()


def test_day_changes_over_from_intraday_to_landed(spark, days, scratch):
    daily, intraday = days
    run(spark, daily, intraday, scratch)
    land(spark, daily, [ev("first_open", "2024-01-05", "10:00", "e", event_id=8), ev("first_open", "2024-01-05", "11:00", "g", event_id=30)])
    assert run(spark, daily, intraday, scratch) == (["20240105"], ["2024-01-05"])
    assert kept_report(spark, scratch + "/report") == whole_report(spark, daily, intraday)
    # a later empty landed day: intraday days before it are not read any more, but are no landed days either
    shards.remove(spark, f"{daily}/suffix=20240105")
    shards.land_empty(spark, daily, "2024-01-06")
    assert run(spark, daily, intraday, scratch) == (["20240105"], ["2024-01-05"])
    assert kept_report(spark, scratch + "/report") == whole_report(spark, daily, intraday)
    assert not os.path.exists(scratch + "/report/cohort_date=2024-01-05")


def test_run_without_its_log_is_done_again(spark, days, scratch):
    daily, intraday = days
    run(spark, daily, intraday, scratch)
    land(spark, daily, [ev("first_open", "2024-01-02", "23:00", "z", event_id=40)])
    assert restate.refresh_days(spark, daily, intraday, scratch + "/state", START, AS_OF) == ["20240102"]
    os.remove(scratch + "/state/log/run=2/_SUCCESS")               # lost before its commit
    assert {r["held_by"] for r in restate.last_log(spark, scratch + "/state").collect()} == {1}
    assert run(spark, daily, intraday, scratch) == (["20240102"], ["2024-01-02"])
    assert kept_report(spark, scratch + "/report") == whole_report(spark, daily, intraday)


def test_event_date_in_two_shards_is_one_day(spark, scratch):
    daily, intraday = scratch + "/daily", scratch + "/none"
    land(spark, daily, [ev("first_open", "2024-01-02", "23:59", "a", event_id=1),
                        ev("signup_result", "2024-01-02", "23:59", "a", OK, suffix="20240103", event_id=2)])
    assert run(spark, daily, intraday, scratch)[1] == ["2024-01-02"]
    land(spark, intraday, [ev("first_open", "2024-01-09", "10:00", "q", event_id=3)])
    run(spark, daily, intraday, scratch)
    assert kept_report(spark, scratch + "/report") == whole_report(spark, daily, intraday)
