"""Declared schemas. Sources read with these, never by inference: the
date suffix must stay a string (inference makes it an integer)."""

from __future__ import annotations

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
])
EVENT_PARAM = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", PARAM_VALUE),
])

# One row per app event, as exported by the analytics warehouse.
EVENTS = T.StructType([
    T.StructField("event_name", T.StringType()),
    T.StructField("event_date", T.StringType()),          # yyyyMMdd
    T.StructField("event_timestamp", T.LongType()),       # microseconds, UTC
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
    T.StructField("geo", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("platform", T.StringType()),
    T.StructField("app_info", T.StructType([T.StructField("version", T.StringType())])),
    T.StructField("event_id", T.LongType()),              # tie-break key
])
EVENT_COLUMNS = ["event_name", "event_date", "event_timestamp", "user_pseudo_id",
                 "event_params", "geo", "platform"]
SUFFIX = "suffix"

SIGNUP_REPORT = T.StructType([
    T.StructField("cohort_date", T.DateType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("first_opens", T.LongType()),
    T.StructField("registered", T.LongType()),
    T.StructField("registered_rate", T.DoubleType()),
    T.StructField("google", T.LongType()),
    T.StructField("phone", T.LongType()),
    T.StructField("apple", T.LongType()),
    T.StructField("facebook", T.LongType()),
    T.StructField("kakao", T.LongType()),
    T.StructField("unknown", T.LongType()),
    T.StructField("android_first_opens", T.LongType()),
    T.StructField("android_registered", T.LongType()),
])

ASSIGNMENTS = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("grp", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("platform", T.StringType()),
])

FUNNEL_STEPS = T.StructType([
    T.StructField("grp", T.StringType()),
    T.StructField("step_no", T.IntegerType()),
    T.StructField("step", T.StringType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("lesson_ids", T.ArrayType(T.LongType())),
    T.StructField("require_success", T.BooleanType()),
])

KNOWN_GAPS = T.StructType([
    T.StructField("grp", T.StringType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("step", T.StringType()),
])

ORDERS = T.StructType([
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("order_ts", T.LongType()),              # microseconds, UTC
    T.StructField("status", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 2)),
])

FEEDBACK = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("context", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("demo", T.StringType()),
])

SPEECH_SEGMENTS = T.StructType([
    T.StructField("session", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("is_final", T.BooleanType()),
])

POOL = T.StructType([T.StructField(c, T.StringType()) for c in (
    "id", "title", "module", "product", "priority", "release_version", "backend_version",
    "requester", "note", "status", "depends_on")])

RELEASE = T.StructType(
    [T.StructField(c, T.StringType()) for c in (
        "id", "name", "module", "type", "priority", "app_version", "backend_version",
        "requester", "brief", "status", "product", "owner", "dev", "tester", "prd_doc", "ui_doc", "tech_doc")]
    + [T.StructField("submit_date", T.DateType()), T.StructField("release_date", T.DateType())])

STATUS_LOG = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("seq", T.LongType()),
])
