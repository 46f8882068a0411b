"""Adapter from the driver's test tables to the library's input shapes.

The rules are plain column expressions over the given tables, so every
fixture grows with its table and Spark runs it as a narrow projection.
``k`` is the integer at ``$.k`` of ``events.props``. The DuckDB oracle
in ``cohortloom.plans.oracle`` applies the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import dims
from cohortloom.session import shared_folder
from cohortloom.sources import shards

# --- fixed values: fixture derivation ---------------------------------
EVENT_NAMES = [("view", "first_open"), ("signup", "signup_result"),
               ("click", "experiment_group_assign"),
               ("purchase", "subscription_checkout_start"), ("error", "lesson_event")]
# user_id % 8 -> country; 7 -> null
COUNTRIES = ["Vietnam", "Indonesia", "Malaysia", "Saudi Arabia", "Thailand",
             "South Korea", "Japan", None]
# k % 7 -> sign-up method text; 6 -> no method parameter
METHODS = ["Google", "phone", "apple", "facebook", "KAKAO", "email", None]
APP_VERSIONS = ["1.4.0", "1.4.2", "1.5.1"]
LESSONS = [732, 1615, 734, 733, 1613, 1614, 1661]
DAILY_BEFORE = "20240125"      # days before this are landed
INTRADAY_FROM = "20240124"     # intraday overlaps one landed day
EMPTY_LANDED = "20240125"      # landed without events, after the last day with events
STRAY_DAY = "20240120"         # its events lie a second time in a daily folder that is no day
LATE_DAYS = ["20240110", "20240118"]    # days whose every tenth event lands late
START_DATE = "2024-01-01"
AS_OF = "2024-01-31"
# inside the data, so window, cutoff and maturity have rows on both sides
ASSIGN_START = "2024-01-01 06:00:00"
ASSIGN_CUTOFF = "2024-01-28 12:00:00"
# the alert period ends after the last event
ALERT_START = "2024-01-01 00:00:00"
ALERT_END = "2024-02-02 00:00:00"
IMAGE_PREFIX = "data:image/jpeg;base64,"
# requirement workflow fixture
RELEASE_VERSION_CHANGED = "1.9.9"
OTHER_RELEASE_TYPES = ["紧急Bug", "研发优化", "体验优化"]
# speech / feedback
FEEDBACK_BLANK_TEXT = " \t\n "
FEEDBACK_LONG_NAME = "x" * 20
# release table: (field, prefix of its text, divisor and remainder of the keys that leave it empty)
RELEASE_TEXTS = [("owner", "own", 11, 0), ("dev", "dev", 13, 0), ("tester", "qa", 6, 0),
                 ("prd_doc", "prd/", 8, 3), ("ui_doc", "ui/", 5, 2), ("tech_doc", "tech/", 7, 4)]
# (field, first day, divisor and remainder of the keys that leave it empty)
RELEASE_DATES = [("submit_date", "2026-07-01", 9, 0), ("release_date", "2026-08-01", 10, 1)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    """``values[index]`` as a CASE over a literal list."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v)
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _param(key, string_value=None, int_value=None) -> Column:
    return F.struct(
        (key if isinstance(key, Column) else F.lit(key)).alias("key"),
        F.struct(
            (string_value if isinstance(string_value, Column) else F.lit(string_value))
            .cast("string").alias("string_value"),
            (int_value if isinstance(int_value, Column) else F.lit(int_value))
            .cast("bigint").alias("int_value"),
        ).alias("value"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def group_rule(uid: Column, k: Column) -> Column:
    even = (uid % 2) == 0
    # every 23rd device has fallback and both groups, every 17th both groups
    flip = (((uid % 17) == 0) & ((k % 2) == 1)) | (((uid % 23) == 0) & ((k % 4) == 1))
    return (F.when(((uid % 23) == 0) & ((k % 4) == 0), F.lit(dims.FALLBACK_GROUP))
            .when(even != flip, F.lit("A")).otherwise(F.lit("B")))


def param_rows() -> list[tuple]:
    """Every distinct parameter array of the test events, keyed by
    (event_type, pk, grp): sign-up arrays repeat with k % 28 (method
    k % 7, key k % 2, success k % 4), lesson arrays with k % 7, and
    assignment arrays with the group. About 40 rows."""
    success = [("is_success", ("true", None)), ("is_success", (None, 1)),
               ("result", ("success", None)), ("is_success", ("false", None))]
    rows = []
    for r in range(28):
        arr = []
        if r % 7 != 6:
            arr.append(("method" if r % 2 == 1 else "signup_method", (METHODS[r % 7], None)))
        arr.append(success[r % 4])
        rows.append(("signup", r, "", arr))
    for r in range(7):
        rows.append(("error", r, "", [("lesson_id", (None, LESSONS[r]))]))
    for g in ("A", "B", dims.FALLBACK_GROUP):
        rows.append(("click", 0, g, [("experiment", (dims.EXPERIMENT, None)), ("group", (g, None))]))
    return rows


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> warehouse-shaped app events with a ``suffix`` column.

    The parameter arrays come from a small literal dimension joined by
    broadcast, so ``event_params`` is a plain column downstream (cheap to
    reference, small generated code).
    """
    k = _k()
    uid = F.col("user_id")
    etype = F.col("event_type")
    ev = (read_table(spark, sf_dir, "events")
          .select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("t"),
                  F.when(etype == "signup", k % 28).when(etype == "error", k % 7).otherwise(F.lit(0))
                  .cast("int").alias("pk"),
                  F.when(etype == "click", group_rule(uid, k)).otherwise(F.lit("")).alias("grp"),
                  _pick(APP_VERSIONS, k % 3).alias("version")))
    dim_schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("pk", T.IntegerType()),
                               T.StructField("grp", T.StringType()),
                               T.StructField("event_params", T.ArrayType(schemas.EVENT_PARAM))])
    rows = param_rows()
    dim = F.broadcast(spark.createDataFrame(rows, dim_schema))   # ~40 literal rows
    name = None
    for src, dst in EVENT_NAMES:
        name = F.when(etype == src, F.lit(dst)) if name is None else name.when(etype == src, F.lit(dst))
    event_date = F.date_format(F.col("t"), "yyyyMMdd")
    return ev.join(dim, ["event_type", "pk", "grp"], "left").select(
        name.alias("event_name"),
        event_date.alias("event_date"),
        F.unix_micros(F.col("t")).alias("event_timestamp"),
        F.concat(F.lit("d"), uid.cast("string")).alias("user_pseudo_id"),
        F.coalesce(F.col("event_params"), F.array().cast(T.ArrayType(schemas.EVENT_PARAM))).alias("event_params"),
        F.struct(_pick(COUNTRIES, uid % 8).cast("string").alias("country")).alias("geo"),
        F.when((uid % 5) == 0, F.lit("IOS")).otherwise(F.lit("ANDROID")).alias("platform"),
        F.struct(F.col("version")).alias("app_info"),
        F.col("event_id"),
        event_date.alias(schemas.SUFFIX),
    )


#: Names of the events that the input metrics without a named event take.
SCREEN_EVENTS = {"lesson_finish": "lesson_done", "paywall_1": "paywall_view"}


def screen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App events, and from every second lesson event a finish, from every
    third assignment a paywall view."""
    ev = app_events(spark, sf_dir)
    more = lambda name, of, n: ev.where((F.col("event_name") == of) & (F.col("event_id") % n == 0)).withColumn("event_name", F.lit(name))
    return (ev.unionByName(more(SCREEN_EVENTS["lesson_finish"], dims.LESSON_EVENT, 2))
            .unionByName(more(SCREEN_EVENTS["paywall_1"], dims.ASSIGN_EVENT, 3)))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_events(spark, sf_dir).where(F.col(schemas.SUFFIX) < DAILY_BEFORE)


def intraday_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_events(spark, sf_dir).where(F.col(schemas.SUFFIX) >= INTRADAY_FROM)


def late_event() -> Column:
    return F.col(schemas.SUFFIX).isin(LATE_DAYS) & (F.col("event_id") % 10 == 3)


def shard_folders(spark: SparkSession, sf_dir: str, with_late: bool = True) -> tuple[str, str]:
    """Write the events as day shards; returns the daily and the intraday
    folder. The last landed day is empty, one daily folder is no day."""
    base = shared_folder(spark, "shards")
    daily, intraday = f"{base}/daily", f"{base}/intraday"
    landed = daily_events(spark, sf_dir)
    if not with_late:
        landed = landed.where(~late_event())
    stray = landed.where(F.col(schemas.SUFFIX) == STRAY_DAY).withColumn(schemas.SUFFIX, F.concat(F.lit("intraday_"), schemas.SUFFIX))
    shards.write_shards(landed.unionByName(stray), daily)
    shards.write_shards(intraday_events(spark, sf_dir), intraday)
    shards.land_empty(spark, daily, EMPTY_LANDED)
    return daily, intraday


def raw_folder(spark: SparkSession, sf_dir: str, late: bool, base: str | None = None) -> str:
    """Event files in order of arrival: the late events, or all others."""
    base = base or shared_folder(spark, "raw")
    events = app_events(spark, sf_dir).where(late_event() if late else ~late_event()).drop(schemas.SUFFIX)
    events.write.mode("append").parquet(base)
    return base


def feedback_lines(spark: SparkSession, sf_dir: str) -> str:
    """Feedback records as JSON lines; some are cut off, some have a text
    in place of their images."""
    path = shared_folder(spark, "feedback")
    rec = feedback_records(spark, sf_dir)
    whole = F.to_json(F.struct(*[f.name for f in schemas.FEEDBACK]))
    typed = F.to_json(F.struct("name", "text", F.lit("no list").alias("images"), "context", "page", "demo"))
    did = F.col("doc_id")
    line = (F.when(did % 29 == 4, F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int")))
            .when(did % 31 == 5, typed).otherwise(whole))
    rec.select(line.alias("value")).write.text(path)
    return path


def land_late(spark: SparkSession, sf_dir: str, daily: str) -> None:
    """The late events as further files of their days."""
    shards.write_shards(daily_events(spark, sf_dir).where(late_event()), daily)


def orders_prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events -> production orders."""
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    k = _k()
    return ev.select(
        F.concat(F.lit("d"), F.col("user_id").cast("string")).alias("user_pseudo_id"),
        F.col("event_id").alias("order_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("order_ts"),
        F.when((k % 2) == 0, F.lit(dims.ORDER_SUCCESS)).otherwise(F.lit("FAILED")).alias("status"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )


def speech_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select(
        F.col("conv_id").cast("string").alias("session"),
        F.col("turn").cast("bigint").alias("pos"),
        F.col("text"),
        (F.col("role") == "user").alias("is_final"),
    )


def feedback_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a page from ``pages`` -> feedback records.

    The page count is a scalar subquery inside the same plan; the page
    lookup is an equi-join on ``doc_id % n_pages``.
    """
    docs = read_table(spark, sf_dir, "documents")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    n_pages = F.greatest(pages.select(F.count(F.lit(1))).scalar(), F.lit(1))   # scalar subquery
    did = F.col("doc_id")
    images = F.transform(F.array_repeat(F.lit(0), (did % 13).cast("int")),
                         lambda _x, i: F.concat(F.lit(IMAGE_PREFIX), F.lit("img"), did.cast("string"),
                                                F.lit("_"), i.cast("string")))
    base = docs.select(
        did,
        F.when((did % 3) == 0, F.lit(None).cast("string"))
         .when((did % 19) == 0, F.concat(F.lit("n"), did.cast("string"), F.lit(FEEDBACK_LONG_NAME)))
         .otherwise(F.concat(F.lit("n"), did.cast("string"))).alias("name"),
        F.when((did % 10) == 0, F.lit(FEEDBACK_BLANK_TEXT)).otherwise(F.col("text")).alias("text"),
        images.alias("images"),
        F.col("lang").alias("context"),
        F.col("source").alias("demo"),
        (did % n_pages).alias("page_id"),
    )
    return (base.join(pages, "page_id", "left")
            .select("doc_id", "name", "text", "images", "context",
                    F.col("url").alias("page"), "demo"))


def pool_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` -> requirement pool rows."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    pk = F.col("p_partkey")
    size = F.col("p_size")
    is_backend = (pk % 4) == 0
    backend_product = F.when(((pk / 4).cast("bigint") % 2) == 0, F.lit("配套后台")).otherwise(F.lit("单词管台"))
    batch = (F.when((pk % 3) == 0, F.concat(F.lpad(((size % 12) + 1).cast("string"), 2, "0"),
                                            F.lpad(((size % 28) + 1).cast("string"), 2, "0")))
             .when((pk % 3) == 1, F.concat(F.lit("2026W"), F.lpad(((size % 52) + 1).cast("string"), 2, "0")))
             .otherwise(F.concat(F.lit("W"), F.lpad(((size % 52) + 1).cast("string"), 2, "0"))))
    status = (F.when((pk % 6) == 1, F.lit(None).cast("string"))
              .when((pk % 6) == 3, F.lit(dims.POOL_DONE_STATUS))
              .when((pk % 6) == 5, F.lit("开发中"))
              .otherwise(F.lit(dims.POOL_HANDOFF_STATUS)))
    return part.select(
        pk.cast("string").alias("id"),
        F.concat(F.col("p_name"), F.lit(" #"), pk.cast("string")).alias("title"),
        F.col("p_brand").alias("module"),
        F.when(is_backend, backend_product).otherwise(F.lit(dims.APP_PRODUCT)).alias("product"),
        F.concat(F.lit("P"), (size % 4).cast("string")).alias("priority"),
        F.when(~is_backend | ((pk % 8) == 0),
               F.concat(F.lit("V1."), (size % 6).cast("string"), F.lit(".0"))).alias("release_version"),
        F.when(is_backend, F.concat(backend_product, F.lit("-"), batch))
         .when((pk % 9) == 1, F.lit("配套后台-0703")).alias("backend_version"),
        F.concat(F.lit("req"), (pk % 10).cast("string")).alias("requester"),
        F.col("p_type").alias("note"),
        status.alias("status"),
        F.when((pk % 10) == 0, (pk + 1).cast("string")).alias("depends_on"),
    )


def _execution_fields(key: Column) -> dict[str, Column]:
    out = {name: F.when((key % n) != r, F.concat(F.lit(prefix), key.cast("string"))) for name, prefix, n, r in RELEASE_TEXTS}
    for name, first, n, r in RELEASE_DATES:
        out[name] = F.when((key % n) != r, F.date_add(F.lit(first).cast("date"), (key % 30).cast("int")))
    return out


def release_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release table: product requirements handed over from the pool,
    plus the other three source types from ``supplier``; execution fields
    filled by key, each left empty for some."""
    from cohortloom.operators.workflow import pool_to_release, release_union

    pool = pool_table(spark, sf_dir)
    pk = F.col("id").cast("bigint")
    handed = (pool_to_release(pool.where((pk % 5) != 0))
              .withColumn("app_version", F.when((pk % 7) == 0, F.lit(RELEASE_VERSION_CHANGED))
                          .otherwise(F.col("app_version")))
              .withColumns(_execution_fields(pk))
              .withColumn("status", _pick(dims.RELEASE_STATUS_CHAIN + [dims.RELEASE_HOLD_STATUS], pk % 8)))
    handed_map = {f.name: f.name for f in schemas.RELEASE if f.name != "type"}
    return release_union({dims.PRODUCT_REQUIREMENT: (handed, handed_map), **other_sources(spark, sf_dir)})


def other_sources(spark: SparkSession, sf_dir: str) -> dict:
    """The three sources beside the pool, each a third of ``supplier`` in a
    shape of its own, with its mapping to the release table."""
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    sk = F.col("s_suppkey")
    key = F.concat(F.lit("s"), sk.cast("string"))
    version = F.concat(F.lit("1."), (sk % 6).cast("string"), F.lit(".0"))
    status = _pick(dims.RELEASE_STATUS_CHAIN + [dims.RELEASE_HOLD_STATUS], sk % 8)
    execution = _execution_fields(sk)
    fields = [c.alias(n) for n, c in execution.items()]
    same = {n: n for n in execution}
    fixed = {"module": F.lit("Brand#0"), "requester": F.lit("dev"), "product": F.lit(dims.APP_PRODUCT)}
    third = [sup.where(sk % 3 == i) for i in range(3)]
    bugs = third[0].select(key.alias("bug_no"), F.col("s_name").alias("summary"), version.alias("fix_version"), status.alias("state"), *fields)
    own = third[1].select(F.struct(key.alias("key"), F.col("s_name").alias("topic")).alias("task"), version.alias("version"),
                          F.concat(F.lit("V"), version).alias("label"), status.alias("status"), *fields)
    online = third[2].select(sk.alias("number"), F.col("s_name").alias("what"), F.array(version).alias("versions"), status.alias("status"), *fields)
    name = lambda c: F.concat(F.lit("sup "), F.col(c))
    bug_type, own_type, online_type = OTHER_RELEASE_TYPES
    return {
        bug_type: (bugs, {"id": "bug_no", "name": name("summary"), "priority": F.lit("P0"), "app_version": "fix_version",
                          "status": "state", **fixed, **same}),
        own_type: (own, {"id": F.col("task.key"), "name": name("task.topic"), "priority": F.lit("P1"), "app_version": "version",
                         "status": "status", **fixed, **same}),
        online_type: (online, {"id": F.concat(F.lit("s"), F.col("number").cast("string")), "name": name("what"), "priority": F.lit("P2"),
                               "app_version": F.col("versions")[0], "status": "status", **fixed, **same}),
    }


def linked_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool with chains of up to five links and cycles of three, by the
    last digit of the key: 0 to 4 depend on the next record, so does 6,
    which runs into the cycle 7, 8, 9."""
    pool = pool_table(spark, sf_dir)
    pk = F.col("id").cast("bigint")
    target = F.when((pk % 10).isin(0, 1, 2, 3, 4, 6, 7, 8), pk + 1).when(pk % 10 == 9, pk - 2)
    return pool.withColumn("depends_on", target.cast("string"))


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes of both workflow tables.

    Release rows from ``orders``: id = customer, ts = order date, status =
    element ``o_orderkey % 8`` of the release chain (plus hold), ``seq``
    breaks ties. Pool rows from ``lineitem``: id = part, ts = ship date,
    status = element ``(l_orderkey + l_linenumber) % 7`` of the pool chain,
    ``seq = l_orderkey * 10 + l_linenumber``.
    """
    orders = read_table(spark, sf_dir, "orders")
    chain = dims.RELEASE_STATUS_CHAIN + [dims.RELEASE_HOLD_STATUS]
    release = orders.select(
        F.lit("release").alias("table_name"),
        F.col("o_custkey").cast("string").alias("id"),
        _pick(chain, F.col("o_orderkey") % 8).alias("status"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        F.col("o_orderkey").alias("seq"),
    )
    items = read_table(spark, sf_dir, "lineitem")
    pool = items.select(
        F.lit("pool").alias("table_name"),
        F.col("l_partkey").cast("string").alias("id"),
        _pick(dims.POOL_STATUS_CHAIN, (F.col("l_orderkey") + F.col("l_linenumber")) % 7).alias("status"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    return release.unionByName(pool)

# known gap used on the test tables so the flag has rows to mark
FIXTURE_GAPS = [("B", "1.4.2", "lesson_start")]


def part_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select("p_partkey", F.concat(F.col("p_name"), F.lit(" #"),
                                             F.col("p_partkey").cast("string")).alias("title"))


def feedback_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted feedback with its triage destination and, when routed to
    the pool or to testing, the linked requirement title (missing on
    purpose for doc_id % 7 = 0)."""
    from cohortloom.operators.feedback import feedback_accepted

    acc = feedback_accepted(feedback_records(spark, sf_dir))
    titles = part_titles(spark, sf_dir)
    n_parts = F.greatest(titles.select(F.count(F.lit(1))).scalar(), F.lit(1))   # scalar subquery
    did = F.col("doc_id")
    dest = _pick(dims.FEEDBACK_DESTINATIONS, did % 4)
    linked = dest.isin("pool", "test") & ((did % 7) != 0)
    base = acc.select("doc_id", dest.alias("destination"),
                      F.when(linked, did % n_parts).alias("p_partkey"))
    return (base.join(titles, "p_partkey", "left")
            .select("doc_id", "destination", F.col("title").alias("link")))
