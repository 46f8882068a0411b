"""Streams that run on: monitor with late rows and silent keys, day
change-over, record lines that are no records."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.operators import alerts, feedback
from cohortloom.sources import events as S
from cohortloom.sources import files, shards
from cohortloom.streaming import intake, monitor
from tests.event_rows import ev, events_df

DAY = "2024-01-05"
NAMES = ["first_open", "signup_result"]


def wait(*queries):
    for q in queries:
        q.awaitTermination(300)
        assert q.exception() is None


def raw(spark, path, rows):
    events_df(spark, rows).drop(schemas.SUFFIX).coalesce(1).write.mode("append").parquet(path)


def opens(hours, name="first_open", day=DAY, tag=""):
    return [ev(name, day, f"{h:02d}:10", f"u{tag}{h}", event_id=hash((name, day, h, tag)) % 10**9) for h in hours]


def test_monitor_counts_late_rows_and_reports_silence(spark, scratch):
    src, store = scratch + "/raw", scratch + "/store"

    def run(**more):
        wait(monitor.zero_monitor_stream(spark, src, store, scratch + "/ckpt", f"{DAY} 00:00", NAMES, dim_values=["VN"],
                                         available_now=True, **more))

    def runs():
        return {(r["event_name"], r["zero_from"][-5:], r["zero_to"][-5:], r["zero_hours"], r["is_open"])
                for r in monitor.zero_alerts(spark, store).collect()}

    everything = opens([0, 1, 2, 9]) + opens([0, 10], "signup_result")
    raw(spark, src, everything)
    run()
    # hours 3 to 8 without a first open; sign-ups silent in 1 to 9; the clock is in hour 10
    assert runs() == {("first_open", "03:00", "08:00", 6, False), ("signup_result", "01:00", "09:00", 9, True)}
    late = opens([5], tag="late")
    raw(spark, src, late + opens([17, 18], "screen_view"))    # no key event: only the clock goes on
    run()
    # the late row splits the first run; both keys are silent while the stream runs
    assert runs() == {("first_open", "10:00", "17:00", 8, True), ("signup_result", "01:00", "09:00", 9, False),
                      ("signup_result", "11:00", "17:00", 7, True)}
    seen = {r["event_name"]: r["silent_hours"] for r in monitor.last_seen(spark, store).collect()}
    assert seen == {"first_open": 9, "signup_result": 8}
    run()                                                      # started again without new files: nothing changes
    batch = alerts.hourly_counts(events_df(spark, everything + late), NAMES)
    got = monitor.key_counts(spark, store)
    assert got.exceptAll(batch.select(*got.columns)).count() == 0 and got.count() == batch.count()


def test_batch_that_runs_again_counts_once_and_folds(spark, scratch):
    src, store = scratch + "/raw", scratch + "/store"
    for h in range(7):
        raw(spark, src, opens([h, h + 1], tag=str(h)))
    wait(monitor.zero_monitor_stream(spark, src, store, scratch + "/ckpt", f"{DAY} 00:00", NAMES, files_per_batch=1, fold_every=3,
                                     available_now=True))
    assert monitor._batches(spark, store + "/folded") == [2, 5]
    before = sorted(map(tuple, monitor.all_counts(spark, store).collect()))
    assert sum(n for _, _, _, n in before) == 14
    # a lost commit: the last batch is done again
    last = max(int(f) for f in os.listdir(scratch + "/ckpt/commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{scratch}/ckpt/commits/{name}")
    wait(monitor.zero_monitor_stream(spark, src, store, scratch + "/ckpt", f"{DAY} 00:00", NAMES, files_per_batch=1, fold_every=3,
                                     available_now=True))
    assert sorted(map(tuple, monitor.all_counts(spark, store).collect())) == before


def test_allowed_hours_hold_back_young_runs(spark, scratch):
    src, store = scratch + "/raw", scratch + "/store"
    raw(spark, src, opens([0]) + opens([8], "screen_view"))
    for allow, found in ((0, 1), (2, 0)):
        wait(monitor.zero_monitor_stream(spark, src, f"{store}{allow}", f"{scratch}/ckpt{allow}", f"{DAY} 00:00", ["first_open"],
                                         dim_values=["VN"], allow_hours=allow, available_now=True))
        assert monitor.zero_alerts(spark, f"{store}{allow}").count() == found


def test_day_change_over_equals_batch_union(spark, scratch):
    daily, intraday, out = scratch + "/daily", scratch + "/intraday", scratch + "/out"
    days = {d: [ev("first_open", f"2024-01-{d:02d}", f"{h:02d}:00", f"u{d}{h}", event_id=d * 100 + h) for h in range(5)] for d in range(2, 7)}
    days[5].append(ev("first_open", "2024-01-05", "23:00", "null-id", event_id=-1))

    def run():
        wait(intake.changeover_stream(spark, daily, intraday, out, scratch + "/ckpt", available_now=True))

    for d in (2, 3):
        shards.write_shards(events_df(spark, days[d]), daily)
    stray = [r[:9] + ("intraday_20240102",) for r in days[2]]
    shards.write_shards(events_df(spark, stray), daily)
    for d in (4, 5):
        shards.write_shards(events_df(spark, days[d][:3]), intraday)     # partial so far
    run()
    for d in (4, 5):
        shards.write_shards(events_df(spark, days[d]), daily)            # the whole day lands
    shards.write_shards(events_df(spark, days[6]), intraday)
    run()
    run()
    cut = S.landed_max(spark, base=daily)
    batch = S.union_events(S.read_shards(spark, daily), S.read_shards(spark, intraday), "2024-01-01", cut, "2024-01-31",
                           ["first_open"], ("event_id", schemas.SUFFIX))
    got = S.read_shards(spark, out).select(*batch.columns)
    assert cut == "20240105" and got.count() == 26
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


LINES = ['{"name":"a","text":"hi","images":["x"],"page":"p?q=1","demo":"d1"}', '{"name":"b","text":"no end', '',
         '{"name":"c","text":"t","images":"one","demo":"d2"}', '[1, 2]', '"text"', '{"name":"d","text":"  ","demo":"d1"}', '   ', 'null', '{}']


def test_broken_lines_are_rejected_in_batch_and_stream(spark, scratch):
    src = scratch + "/in"
    spark.createDataFrame([(x,) for x in LINES], "value string").coalesce(1).write.text(src)
    intake.land_feedback(spark, src, scratch + "/acc", scratch + "/rej")
    wait(*intake.feedback_intake_stream(spark, src, scratch + "/acc_s", scratch + "/rej_s", scratch + "/ckpt", available_now=True))
    rows = {}
    for tag in ("", "_s"):
        acc = spark.read.parquet(scratch + "/acc" + tag).select("name", "text", "page", "demo").collect()
        rej = spark.read.parquet(scratch + "/rej" + tag).select("line", "reason").collect()
        rows[tag] = sorted(map(tuple, acc)), sorted(map(tuple, rej), key=str)
    assert rows[""] == rows["_s"]
    assert rows[""][0] == [("a", "hi", "p", "d1")]
    assert dict(r for r in rows[""][1] if r[0]) == {LINES[1]: "not_json", LINES[3]: "wrong_type", LINES[4]: "wrong_type",
                                                    LINES[5]: "wrong_type", "null": "wrong_type"}
    assert [r[1] for r in rows[""][1] if not r[0]] == ["empty", "empty"]       # good lines without content
    records = files.read_feedback(spark, src)
    assert records.count() == len([x for x in LINES if x.strip()])
    # a whole record that is read as such passes the same rules with and without the line column
    good = records.where(F.col("line").isNull())
    assert feedback.feedback_accepted(good).count() == feedback.feedback_accepted(good.drop("line")).count() == 1
