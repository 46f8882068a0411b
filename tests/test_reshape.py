"""R-2 / R-3: densify, totals, labels, payloads, CSV in and out."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest

from cohortloom import schemas
from cohortloom.operators import reshape
from cohortloom.sources import files


def _row(day, cc, n, r, **m):
    vals = {k: m.get(k, 0) for k in ("google", "phone", "apple", "facebook", "kakao", "unknown")}
    return (dt.date.fromisoformat(day), cc, n, r, round(100 * r / n, 1), *vals.values(), m.get("an", 0), m.get("as_", 0))


@pytest.fixture()
def report(spark):
    rows = [_row("2024-01-01", "VN", 5, 2, google=2, an=4, as_=1),
            _row("2024-01-03", "VN", 3, 1, phone=1),
            _row("2024-01-03", "JP", 7, 7, unknown=7, an=7, as_=7),   # outside the list
            _row("2024-01-04", "KR", 2, 0)]
    return spark.createDataFrame(rows, schemas.SIGNUP_REPORT)


def test_repeated_report_row_raises(report):
    with pytest.raises(Exception, match="several rows for a day and country"):
        reshape.method_matrix_tall(report.union(report.limit(1)), "2024-01-01").collect()


def test_dense_matrix_keeps_calendar_gaps(report):
    tall = reshape.method_matrix_tall(report, "2024-01-02")
    assert tall.count() == 7 * 2          # days 01-03 and 01-04 only; 01-02 is not invented
    got = {(r["country_code"], r["cohort_date"].isoformat()): r["first_opens"] for r in tall.collect()}
    assert got[("VN", "2024-01-03")] == 3 and got[("KR", "2024-01-03")] == 0 and ("JP", "2024-01-03") not in got


def test_array_form_order(report):
    arr = {r["country_code"]: (r["sort_no"], r["values"]) for r in reshape.method_matrix_array(report, "2024-01-01").collect()}
    assert arr["VN"][0] == 0 and arr["Other"][0] == 6
    assert arr["VN"][1] == [[5, 2, 2, 0, 0, 0, 0, 0], [3, 1, 0, 1, 0, 0, 0, 0], [0] * 8]


def test_totals_include_all_countries_and_star_latest(report):
    t = {r["cohort_date"].isoformat(): r for r in reshape.daily_totals(report).collect()}
    assert t["2024-01-03"]["n"] == 10 and t["2024-01-03"]["as"] == 7
    assert t["2024-01-04"]["d"] == "01-04*" and t["2024-01-01"]["d"] == "01-01"


def test_payloads_are_compact_json(report):
    p = {r["name"]: r["payload"] for r in reshape.payloads(report, "2024-01-03").collect()}
    assert p["AUTH_METHOD_DAYS"] == '["01-03","01-04*"]'
    data = json.loads(p["AUTH_METHOD_DATA"])
    assert list(data) == ["VN", "ID", "MY", "SA", "TH", "KR", "Other"]
    assert " " not in p["REG_DAILY"] and json.loads(p["REG_DAILY"])[0] == {"d": "01-01", "n": 5, "s": 2, "an": 4, "as": 1}


def test_payloads_with_no_method_days(report):
    p = {r["name"]: r["payload"] for r in reshape.payloads(report, "2030-01-01").collect()}
    assert p["AUTH_METHOD_DAYS"] == "[]"
    assert json.loads(p["AUTH_METHOD_DATA"]) == {c: [] for c in ["VN", "ID", "MY", "SA", "TH", "KR", "Other"]}


def test_csv_round_trip_and_empty_input(spark, report, scratch):
    path = os.path.join(scratch, "report_csv")
    files.write_report_csv(report, path)
    back = files.read_report_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, report.collect()))
    empty = os.path.join(scratch, "empty_csv")
    os.makedirs(empty)
    with open(os.path.join(empty, "part.csv"), "w") as fh:
        fh.write(",".join(f.name for f in schemas.SIGNUP_REPORT) + "\n")
    with pytest.raises(ValueError):
        files.read_report_csv(spark, empty)


def test_write_daily_restates_only_rerun_days(spark, report, scratch):
    path = os.path.join(scratch, "daily")
    files.write_daily(report, path)
    late = report.where("cohort_date = DATE'2024-01-04'").withColumn("first_opens", report.first_opens + 1)
    files.write_daily(late, path)
    back = {(r["cohort_date"].isoformat(), r["country_code"]): r["first_opens"]
            for r in spark.read.parquet(path).collect()}
    assert back[("2024-01-04", "KR")] == 3 and back[("2024-01-01", "VN")] == 5


def test_payload_text_sink(spark, report, scratch):
    path = os.path.join(scratch, "payload_txt")
    files.write_payloads(reshape.payloads(report, "2024-01-03"), path)
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines[0] == 'const AUTH_METHOD_DATA={"VN":[[3,1,0,1,0,0,0,0],[0,0,0,0,0,0,0,0]],' \
        '"ID":[[0,0,0,0,0,0,0,0],[0,0,0,0,0,0,0,0]],"MY":[[0,0,0,0,0,0,0,0],[0,0,0,0,0,0,0,0]],' \
        '"SA":[[0,0,0,0,0,0,0,0],[0,0,0,0,0,0,0,0]],"TH":[[0,0,0,0,0,0,0,0],[0,0,0,0,0,0,0,0]],' \
        '"KR":[[0,0,0,0,0,0,0,0],[2,0,0,0,0,0,0,0]],"Other":[[0,0,0,0,0,0,0,0],[0,0,0,0,0,0,0,0]]};'
    assert lines[1] == 'const AUTH_METHOD_DAYS=["01-03","01-04*"];'
    assert lines[2].startswith('const REG_DAILY=[{"d":"01-01","n":5,"s":2,"an":4,"as":1},')
