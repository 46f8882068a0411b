"""Warehouse-shaped event rows for tests."""

from __future__ import annotations

import datetime as dt

from cohortloom import schemas


def micros(day: str, hhmm: str = "00:00", sec: int = 0) -> int:
    t = dt.datetime.fromisoformat(f"{day}T{hhmm}:00").replace(tzinfo=dt.timezone.utc) + dt.timedelta(seconds=sec)
    return int(t.timestamp()) * 1_000_000


def p(key, s=None, i=None):
    return (key, (s, i))


def ev(name, day, hhmm="00:00", user="u1", params=(), country="Vietnam", platform="ANDROID",
       event_id=None, version="1.4.0", suffix=None, sec=0):
    """One warehouse-shaped event row (tuple in ``schemas.EVENTS`` order
    plus suffix)."""
    d = day.replace("-", "")
    return (name, d, micros(day, hhmm, sec), user, list(params), (country,), platform, (version,),
            event_id, suffix if suffix is not None else d)


def events_df(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType(schemas.EVENTS.fields + [T.StructField(schemas.SUFFIX, T.StringType())])
    rows = [r[:8] + ((r[8] if r[8] is not None else i),) + r[9:] for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, schema)
