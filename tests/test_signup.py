"""Edge rows of the sign-up cohort report."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import signup
from cohortloom.sources import events as S
from tests.event_rows import ev, events_df, p

DAY = "2024-01-10"


def report(spark, daily_rows, intraday_rows=(), start="2024-01-01", landed="20240110", as_of="20240112",
           **kw):
    daily = events_df(spark, daily_rows)
    intraday = events_df(spark, list(intraday_rows)) if intraday_rows else daily.limit(0)
    return signup.signup_country_method_daily(daily, intraday, start, landed, as_of, **kw)


def rows_by_country(df):
    return {r["country_code"]: r.asDict() for r in df.collect()}


def opened(user, country="Vietnam", hhmm="08:00", day=DAY, platform="ANDROID", event_id=None):
    return ev("first_open", day, hhmm, user, country=country, platform=platform, event_id=event_id)


def signed(user, params, hhmm="09:00", day=DAY, event_id=None):
    return ev("signup_result", day, hhmm, user, params=params, event_id=event_id)


def test_no_landed_day_gives_empty_report(spark):
    out = report(spark, [opened("u1")], landed=None)
    assert out.count() == 0


def test_country_map_and_other(spark):
    out = rows_by_country(report(spark, [opened("u1", None), opened("u2", "France"), opened("u3", "Vietnam")]))
    assert out["Other"]["first_opens"] == 2
    assert out["VN"]["first_opens"] == 1


def test_null_device_is_one_open_never_registered(spark):
    rows = [opened(None, hhmm="08:00"), opened(None, hhmm="08:30"),
            signed(None, [p("signup_method", "google"), p("is_success", "true")])]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["first_opens"] == 1
    assert out["VN"]["registered"] == 0


def test_empty_signup_method_blocks_fallback(spark):
    rows = [opened("u1"), signed("u1", [p("signup_method", ""), p("method", "google"), p("is_success", "true")])]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["registered"] == 1 and out["VN"]["unknown"] == 1 and out["VN"]["google"] == 0


@pytest.mark.parametrize("params,expected", [
    ([p("is_success", "false"), p("result", "success")], 0),
    ([p("is_success", None, 1)], 1),
    ([p("is_success", "TRUE")], 1),
    ([p("is_success", " true")], 0),
    ([p("result", "Success")], 1),
    ([], 0),
])
def test_success_value_precedence(spark, params, expected):
    rows = [opened("u1"), signed("u1", [p("signup_method", "phone")] + params)]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["registered"] == expected


def test_duplicate_key_first_wins_or_strict_raises(spark):
    rows = [opened("u1"), signed("u1", [p("signup_method", "apple"), p("signup_method", "kakao"),
                                        p("is_success", "true")])]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["apple"] == 1
    with pytest.raises(Exception):
        report(spark, rows, strict=True).collect()


def test_non_null_method_beats_null_and_unlisted_is_unknown(spark):
    rows = [opened("u1"),
            signed("u1", [p("is_success", "true")], hhmm="09:00"),
            signed("u1", [p("signup_method", "email"), p("is_success", "true")], hhmm="10:00"),
            signed("u1", [p("signup_method", "google"), p("is_success", "true")], hhmm="11:00"),
            opened("u2"), signed("u2", [p("is_success", "true")])]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["registered"] == 2
    assert out["VN"]["unknown"] == 2 and out["VN"]["google"] == 0


def test_signup_next_day_not_registered(spark):
    rows = [opened("u1"), signed("u1", [p("signup_method", "google"), p("is_success", "1")], day="2024-01-11")]
    out = rows_by_country(report(spark, rows, landed="20240111"))
    assert out["VN"]["registered"] == 0


def test_first_open_tie_breaks_by_event_id(spark):
    rows = [opened("u1", "Vietnam", "08:00", event_id=7), opened("u1", "Thailand", "08:00", event_id=3)]
    out = rows_by_country(report(spark, rows))
    assert "TH" in out and "VN" not in out


def test_first_open_is_first_inside_window(spark):
    rows = [opened("u1", "Vietnam", day="2023-12-30"), opened("u1", "Thailand", day=DAY)]
    out = rows_by_country(report(spark, rows, start="2024-01-01"))
    assert list(out) == ["TH"]


def test_landed_before_start_lets_early_intraday_in(spark):
    intraday = [opened("u1", day="2023-12-20")]
    out = report(spark, [opened("u0", day="2023-12-01")], intraday, start="2024-01-01", landed="20231201")
    assert [r["cohort_date"].isoformat() for r in out.collect()] == ["2023-12-20"]


def test_hole_in_landed_days_not_filled(spark):
    daily = [opened("u1", day="2024-01-08"), opened("u2", day="2024-01-10")]
    intraday = [opened("u3", day="2024-01-09"), opened("u4", day="2024-01-11")]
    out = report(spark, daily, intraday, landed="20240110")
    days = sorted(r["cohort_date"].isoformat() for r in out.collect())
    assert days == ["2024-01-08", "2024-01-10", "2024-01-11"]


def test_non_daily_suffix_ignored_by_daily_branch(spark):
    rows = [opened("u1"), ev("first_open", DAY, "08:00", "u2", suffix="intraday_20240110")]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["first_opens"] == 1


def test_counts_identity_and_bounds_on_test_tables(spark):
    from cohortloom.plans.registry import signup_report
    df = signup_report(spark, "/root/testdata/sf0.01")
    bad = df.where((F.col("registered") != F.col("google") + F.col("phone") + F.col("apple") + F.col("facebook")
                    + F.col("kakao") + F.col("unknown"))
                   | (F.col("registered") > F.col("first_opens"))
                   | (F.col("android_registered") > F.col("android_first_opens")))
    assert bad.count() == 0
    assert df.agg(F.sum("first_opens")).first()[0] == 150


def test_rate_rounding(spark):
    rows = [opened(f"u{i}") for i in range(3)] + [signed("u0", [p("signup_method", "google"), p("is_success", "true")])]
    out = rows_by_country(report(spark, rows))
    assert out["VN"]["registered_rate"] == 33.3


def test_landed_max_lists_folders_and_counts_empty_shard(spark, scratch):
    base = os.path.join(scratch, "daily")
    df = events_df(spark, [opened("u1", day="2024-01-08"), opened("u2", day="2024-01-09")])
    df.write.partitionBy("suffix").parquet(base)
    os.makedirs(os.path.join(base, "suffix=20240110"))          # landed, empty
    os.makedirs(os.path.join(base, "suffix=intraday_20240111"))  # not a daily shard
    assert S.landed_max(spark, base) == "20240110"
    assert S.landed_max_from_names(["events_20240101", "events_intraday_20240102", "x"]) == "20240101"
    assert S.landed_max(spark, os.path.join(scratch, "missing")) is None


def test_shard_scan_prunes_days(spark, scratch):
    base = os.path.join(scratch, "daily")
    events_df(spark, [opened("u1", day="2024-01-08"), opened("u2", day="2024-01-09")]) \
        .write.partitionBy("suffix").parquet(base)
    df = S.read_daily(spark, base, "2024-01-09", "20240109").where(F.col("event_name") == "first_open")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan and "first_open" in plan
    assert df.count() == 1


def test_landed_max_from_catalog_partitions(spark, scratch):
    path = os.path.join(scratch, "events_tbl")
    df = events_df(spark, [opened("u1", day="2024-01-08"), opened("u2", day="2024-01-09")])
    df.write.partitionBy("suffix").option("path", path).saveAsTable("cohortloom_test_events")
    try:
        assert S.landed_max(spark, table="cohortloom_test_events") == "20240109"
        spark.sql("ALTER TABLE cohortloom_test_events ADD PARTITION (suffix='20240110')")   # landed, empty
        spark.sql("ALTER TABLE cohortloom_test_events ADD PARTITION (suffix='intraday_1')")  # not a day
        assert S.landed_max(spark, table="cohortloom_test_events") == "20240110"
    finally:
        spark.sql("DROP TABLE IF EXISTS cohortloom_test_events")
