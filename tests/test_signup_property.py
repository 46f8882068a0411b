"""R-1 against a plain-Python model of the report rules on random events."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.operators import signup
from tests.event_rows import ev, events_df, p

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]
USERS = ["u1", "u2", "u3", None]
COUNTRIES = ["Vietnam", "Thailand", "Japan", None]
PARAM_SETS = [
    [], [p("signup_method", "Google"), p("is_success", "true")], [p("method", "phone"), p("is_success", None, 1)],
    [p("signup_method", ""), p("method", "kakao"), p("result", "success")], [p("signup_method", "email"), p("is_success", "1")],
    [p("is_success", "false"), p("result", "success")], [p("signup_method", "apple"), p("signup_method", "facebook"), p("result", "SUCCESS")],
    [p("is_success", "TRUE")], [p("signup_method", "Apple"), p("is_success", " true")],
]
METHODS = ["google", "phone", "apple", "facebook", "kakao"]
CODES = {"Vietnam": "VN", "Indonesia": "ID", "Malaysia": "MY", "Saudi Arabia": "SA", "Thailand": "TH", "South Korea": "KR"}

event = st.tuples(st.sampled_from(["first_open", "signup_result"]), st.sampled_from(DAYS), st.integers(0, 3),
                  st.sampled_from(USERS), st.integers(0, len(PARAM_SETS) - 1), st.sampled_from(COUNTRIES),
                  st.sampled_from(["ANDROID", "IOS"]))


def first(params, key, slot=0):
    for k, v in params:
        if k == key:
            return v[slot]
    return None


def model(rows, landed="20240102", as_of="20240103"):
    kept = [r for r in rows if (r["src"] == "d" and "20240101" <= r["sfx"] <= landed)
            or (r["src"] == "i" and landed < r["sfx"] <= as_of)]
    opens, sign = {}, {}
    for r in kept:
        if r["name"] == "first_open":
            key = (r["ts"], r["id"])
            if r["user"] not in opens or key < opens[r["user"]][0]:
                opens[r["user"]] = (key, r)
        else:
            pr = r["params"]
            m = first(pr, "signup_method")
            m = m if m is not None else first(pr, "method")
            m = m.lower() if m is not None else None
            sv = first(pr, "is_success")
            if sv is None and first(pr, "is_success", 1) is not None:
                sv = str(first(pr, "is_success", 1))
            sv = sv if sv is not None else first(pr, "result")
            if sv is None or sv.lower() not in ("true", "1", "success"):
                continue
            key = (m is None, r["ts"], r["id"])
            k2 = (r["user"], r["day"])
            if k2 not in sign or key < sign[k2][0]:
                sign[k2] = (key, m if m in METHODS else "unknown")
    out = {}
    for user, (_, r) in opens.items():
        cell = out.setdefault((r["day"], CODES.get(r["country"], "Other")),
                               dict(first_opens=0, registered=0, android_first_opens=0, android_registered=0,
                                    **{m: 0 for m in METHODS + ["unknown"]}))
        hit = sign.get((user, r["day"])) if user is not None else None
        cell["first_opens"] += 1
        cell["android_first_opens"] += r["platform"] == "ANDROID"
        if hit:
            cell["registered"] += 1
            cell[hit[1]] += 1
            cell["android_registered"] += r["platform"] == "ANDROID"
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(event, min_size=1, max_size=25))
def test_report_matches_model(spark, events):
    rows, daily, intraday = [], [], []
    for i, (name, day, ts, user, pi, country, platform) in enumerate(events):
        src = "d" if day != "2024-01-03" else "i"
        if day == "2024-01-02" and i % 2:
            src = "i"          # the landed day also appears in intraday: must not count twice
        r = ev(name, day, f"0{ts}:00", user, PARAM_SETS[pi], country, platform, event_id=i)
        (daily if src == "d" else intraday).append(r)
        rows.append(dict(name=name, day=dt.date.fromisoformat(day), sfx=day.replace("-", ""), ts=r[2], id=i,
                         user=user, params=PARAM_SETS[pi], country=country, platform=platform, src=src))
    d = events_df(spark, daily) if daily else events_df(spark, [ev("x", "2024-01-01")]).limit(0)
    i_ = events_df(spark, intraday) if intraday else d.limit(0)
    got = {(r["cohort_date"], r["country_code"]): {k: r[k] for k in r.asDict() if k not in
                                                   ("cohort_date", "country_code", "registered_rate")}
           for r in signup.signup_country_method_daily(d, i_, "2024-01-01", "20240102", "20240103").collect()}
    assert got == model(rows)
