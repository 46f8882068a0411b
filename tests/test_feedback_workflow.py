"""R-9 .. R-14 edge rows."""

from __future__ import annotations


from cohortloom import schemas
from cohortloom.operators import feedback, workflow


def records(spark, rows):
    return spark.createDataFrame(rows, schemas.FEEDBACK)


def test_feedback_rules(spark):
    rows = [("a", "  　\n", [], "c", "p", "d"),                       # blank, no image -> reject
            ("b", "\t", ["img"], "c", "p", "d"),                            # blank with image -> accept
            ("x" * 20, "ok", None, "c", "p", "d"),                          # 20 chars ok
            ("x" * 21, "ok", None, "c", "p", "d"),                          # 21 -> flag
            (None, "ok", ["i"] * 9, "c", "a?b?c", "d"),                     # 9 ok, page a
            (" ", "ok", ["i"] * 10, "c", None, "d"),                        # 10 -> flag
            ("n", "y" * 2001, [], "c", "p", "d"),
            ("﻿z ", " ok ", [], "c", "p", "d")]         # browser trim set
    out = feedback.checked_feedback(records(spark, rows)).collect()
    got = [(r["accepted"], ",".join(r["reasons"])) for r in out]
    assert got == [(False, "empty"), (True, ""), (True, ""), (False, "name_too_long"), (True, ""),
                   (False, "too_many_images"), (False, "text_too_long"), (True, "")]
    assert out[4]["name"] == "匿名" and out[4]["page"] == "a" and out[5]["name"] == "匿名"
    assert out[7]["name"] == "z" and out[7]["text"] == "ok"
    acc = feedback.feedback_accepted(records(spark, rows)).count()
    rej = feedback.feedback_rejected(records(spark, rows)).count()
    assert acc + rej == len(rows)


def test_feedback_limits_count_utf16_units_before_trim(spark):
    rows = [("x" * 18 + "\U0001F600", "ok", [], "c", "p", "d"),     # 20 units
            ("x" * 19 + "\U0001F600", "ok", [], "c", "p", "d"),     # 20 code points, 21 units
            (" " + "x" * 20, "ok", [], "c", "p", "d"),               # 20 after the trim, 21 as entered
            ("n", "\U0001F600" * 1000, [], "c", "p", "d"),
            ("n", "y" * 2000 + " ", [], "c", "p", "d")]
    got = [",".join(r["reasons"]) for r in feedback.checked_feedback(records(spark, rows)).collect()]
    assert got == ["", "name_too_long", "name_too_long", "", "text_too_long"]


def test_routes_need_links(spark):
    triage = spark.createDataFrame([(1, "pool", None), (2, "test", "t1"), (3, "direct", None), (4, "pool", "t9")],
                                   "doc_id long, destination string, link string")
    pool = spark.createDataFrame([("t1",), ("t9",)], "title string")
    release = spark.createDataFrame([("t1",)], "name string")
    r = {x["destination"]: x for x in feedback.feedback_routes(triage, pool, release).collect()}
    assert r["pool"]["missing_link"] == 1 and r["pool"]["in_pool"] == 1 and r["pool"]["in_release"] == 0
    assert r["test"]["in_release"] == 1 and r["direct"]["missing_link"] == 0


def test_transcript_joins_final_pieces_in_order(spark):
    segs = spark.createDataFrame([("s", 3, " third ", True), ("s", 1, "first", True), ("s", 2, "interim", False),
                                  ("s", 5000, "far", True), ("s", 4, "  ", True), ("t", 0, "only", True)],
                                 schemas.SPEECH_SEGMENTS)
    t = {r["session"]: r["text"] for r in feedback.transcript(segs, bucket=2).collect()}
    assert t == {"s": "first\nthird\nfar", "t": "only"}
    lines = [(r["pos"], r["line_no"]) for r in feedback.transcript_lines(segs, bucket=2).where("session = 's'")
             .orderBy("pos").collect()]
    assert lines == [(1, 1), (3, 2), (5000, 3)]


def pool(spark, rows):
    cols = [f.name for f in schemas.POOL]
    return spark.createDataFrame([dict(zip(cols, r)) for r in rows], schemas.POOL)


def release(spark, rows):
    cols = [f.name for f in schemas.RELEASE]
    return spark.createDataFrame([{**dict.fromkeys(cols), **r} for r in rows], schemas.RELEASE)


def test_field_mapping(spark):
    p = pool(spark, [("1", "T1", "m", "用户端", "P3", "V1.3.0", None, "r", "note", None, None),
                     ("2", "T2", "m", "配套后台", "P1", None, "配套后台-0703", "r", "n", "排期中", None),
                     ("3", "T3", "m", "单词管台", "P0", None, "单词管台-2026W28", "r", "n", "排期中", None),
                     ("4", "T4", "m", "单词管台", "P0", None, "x-W28", "r", "n", "排期中", None),
                     ("5", "T5", "m", "用户端", "P0", "1.3.0", "配套后台-0703", "r", "n", "排期中", None)])
    m = {r["id"]: r for r in workflow.pool_to_release(workflow.pool_clean(p)).collect()}
    assert m["1"]["priority"] == "P2" and m["1"]["needs_rerate"] and m["1"]["app_version"] == "1.3.0"
    assert m["1"]["name"] == "T1" and m["1"]["brief"] == "note" and m["1"]["type"] == "产品需求"
    assert [m[k]["valid_version_track"] for k in "12345"] == [True, True, True, False, False]
    st = {r["id"]: r["status"] for r in workflow.pool_clean(p).collect()}
    assert st["1"] == "未启动"


def test_handoff_audit(spark):
    p = pool(spark, [("1", "A", "m", "用户端", "P1", "V1.3.0", None, "r", "n", "排期中", None),
                     ("2", "B", "m", "用户端", "P1", "V1.3.0", None, "r", "n", "排期中", None),
                     ("3", "C", "m", "用户端", "P1", "V1.3.0", None, "r", "n", "开发中", "1"),
                     ("4", "D", "m", "用户端", "P1", None, None, "r", "n", "排期中", None),
                     ("5", "E", "m", "用户端", "P1", "V1.3.0", None, "r", "n", "已完成", "9")])
    r = release(spark, [{"id": "r1", "name": "A", "app_version": "1.3.0", "status": "已上线"},
                        {"id": "r3", "name": "C", "app_version": "1.3.2", "status": "开发中"}])
    assert {x["title"] for x in workflow.handoff_missing(p, r).collect()} == {"B"}
    mm = workflow.version_mismatch(p, r).collect()
    assert [(x["title"], x["pool_version"], x["release_version"]) for x in mm] == [("C", "1.3.0", "1.3.2")]
    assert {x["title"] for x in workflow.not_closed(p, r).collect()} == {"A"}
    dep = {x["id"]: x for x in workflow.dependency_check(p).collect()}
    assert dep["3"]["parent_found"] and not dep["3"]["both_done"]
    assert not dep["5"]["parent_found"]


def test_release_list_and_types(spark):
    r = release(spark, [{"id": "1", "name": "a", "type": "产品需求", "app_version": "1.3.0", "product": "用户端"},
                        {"id": "2", "name": "b", "type": "紧急Bug", "app_version": "V1.3.0", "product": "用户端"},
                        {"id": "3", "name": "c", "type": "研发优化", "app_version": "1.3.2", "product": "用户端"}])
    assert {x["id"] for x in workflow.release_list(r, "V1.3.0").collect()} == {"1", "2"}
    t = {(x["app_version"], x["type"]): x["items"] for x in workflow.release_by_type(r).collect()}
    assert t[("1.3.0", "产品需求")] == 1 and t[("1.3.0", "体验优化")] == 0 and len(t) == 8
    miss = {x["id"]: x["missing"] for x in workflow.release_missing_fields(r).collect()}
    assert miss["1"] == ("module,priority,owner,dev,tester,submit_date,release_date,prd_doc,ui_doc,tech_doc,brief")


def test_test_tables_lack_each_execution_field_somewhere(spark):
    from cohortloom.sources import fixtures as FX
    rows = workflow.release_missing_fields(FX.release_table(spark, "/root/testdata/sf0.001")).collect()
    seen = {f for r in rows for f in r["missing"].split(",")}
    assert set(workflow.EXECUTION_FIELDS) <= seen
    assert any("," in r["missing"] for r in rows)


def test_status_chain(spark):
    log = spark.createDataFrame([
        ("release", "1", "需求沟通中", 1, 1), ("release", "1", "PRD编写中", 2, 2), ("release", "1", "PRD编写中", 3, 3),
        ("release", "1", "开发中", 4, 4), ("release", "1", "挂起", 5, 5), ("release", "1", "测试中", 6, 6),
        ("release", "2", "已上线", 1, 1), ("release", "2", "挂起", 2, 2)], schemas.STATUS_LOG)
    bad = [(x["id"], x["prev_status"], x["status"]) for x in workflow.status_audit(log).orderBy("id", "seq").collect()]
    assert bad == [("1", "PRD编写中", "开发中"), ("2", "已上线", "挂起")]


def test_status_changes_same_for_any_bucket_width(spark):
    from cohortloom.sources import fixtures as FX
    log = FX.status_log(spark, "/root/testdata/sf0.001")
    day = 86_400_000_000
    base = workflow.status_changes(log, 10_000 * day).select("id", "seq", "prev_status")
    for width in (day, 30 * day):
        other = workflow.status_changes(log, width).select("id", "seq", "prev_status")
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0


def test_pool_rows_use_the_pool_chain(spark):
    log = spark.createDataFrame([
        ("pool", "7", "未启动", 1, 1), ("pool", "7", "产品设计中", 2, 2), ("pool", "7", "排期中", 3, 3),
        ("pool", "8", "排期中", 1, 1), ("pool", "8", "挂起", 2, 2)], schemas.STATUS_LOG)
    bad = [(x["id"], x["prev_status"], x["status"]) for x in workflow.status_audit(log).orderBy("id", "seq").collect()]
    assert bad == [("7", "产品设计中", "排期中"), ("8", "排期中", "挂起")]


def test_hot_cells_are_split_and_give_the_same_lag(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from cohortloom.sources import fixtures as FX
    log = FX.status_log(spark, "/root/testdata/sf0.001")
    w = Window.partitionBy("table_name", "id").orderBy("ts", "seq")
    plain = log.select("table_name", "id", "seq", F.lag("status").over(w).alias("prev_status"))
    split = workflow.status_changes(log, chunk=1).select("table_name", "id", "seq", "prev_status")
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def test_record_with_a_third_of_the_log_at_one_time(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [("release", "hot", f"s{i % 7}", i, 5) for i in range(3000)]
    rows += [("release", f"r{i % 900}", f"s{i % 5}", i, i // 900) for i in range(6000)]
    log = spark.createDataFrame(rows, schemas.STATUS_LOG)
    w = Window.partitionBy("table_name", "id").orderBy("ts", "seq")
    plain = log.select("table_name", "id", "seq", F.lag("status").over(w).alias("prev_status"))
    got = workflow.status_changes(log, chunk=100).select("table_name", "id", "seq", "prev_status")
    assert plain.exceptAll(got).count() == 0 and got.count() == len(rows)
