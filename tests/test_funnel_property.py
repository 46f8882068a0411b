"""Funnel reach against a brute-force model of the order-free rule."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.operators import funnel

N_STEPS = 6
STEPS = [(g, i, f"s{i}", f"e{i}", None, False) for g in ("A", "B") for i in range(1, N_STEPS + 1)]


def brute(devs):
    out = {}
    for grp in ("A", "B"):
        for tab in ("VN", "KR", "Other", "ALL"):
            mine = [h for g, c, h in devs if g == grp and (tab == "ALL" or c == tab)]
            if not mine:
                continue
            for k in range(1, N_STEPS + 1):
                out[(grp, tab, k)] = (len(mine), sum(set(range(1, k + 1)) <= h for h in mine),
                                      sum(k in h for h in mine))
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["VN", "KR", "Other"]),
                          st.sets(st.integers(1, N_STEPS))), min_size=1, max_size=40))
def test_reach_matches_brute_force(spark, devs):
    rows = [(f"d{i}", g, c, "1.4.0", sum(1 << s for s in h)) for i, (g, c, h) in enumerate(devs)]
    devices = spark.createDataFrame(rows, "user_pseudo_id string, grp string, country_code string, "
                                          "app_version string, mask bigint")
    got = {(r["grp"], r["country_code"], r["step_no"]): (r["assigned"], r["reached"], r["hit"])
           for r in funnel.funnel_reach(devices, STEPS).collect()}
    assert got == brute(devs)


def test_sixty_two_steps(spark):
    steps = [("A", i, f"s{i}", "e", None, False) for i in range(1, 63)]
    full = sum(1 << s for s in range(1, 63))
    gap = full & ~(1 << 40)
    devices = spark.createDataFrame([("a", "A", "VN", "v", full), ("b", "A", "VN", "v", gap)],
                                    "user_pseudo_id string, grp string, country_code string, app_version string, "
                                    "mask bigint")
    r = {x["step_no"]: x["reached"] for x in funnel.funnel_reach(devices, steps).where("country_code = 'VN'").collect()}
    assert r[39] == 2 and r[40] == 1 and r[62] == 1
