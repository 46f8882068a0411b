"""Date-sharded event sources.

Layout on storage: ``<base>/suffix=YYYYMMDD/*.parquet`` for landed days
and the same under the intraday base for today's partial data. The
suffix is a *string* partition column, so the day filters below become
``PartitionFilters`` and whole days are pruned before any file is opened.
"""

from __future__ import annotations

import datetime as _dt
import logging
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas

log = logging.getLogger(__name__)

_DAY = re.compile(r"^\d{8}$")
#: Columns that are taken along where both branches have them.
EXTRA = ("event_id",)
_DAILY_TABLE = re.compile(r"^events_(\d{8})$")


def day_text(day) -> str:
    """``date`` / ``'YYYY-MM-DD'`` / ``'YYYYMMDD'`` -> ``'YYYYMMDD'``."""
    if day is None:
        return None
    if isinstance(day, (_dt.date, _dt.datetime)):
        return day.strftime("%Y%m%d")
    text = str(day).replace("-", "")
    if not _DAY.match(text):
        raise ValueError(f"not a day: {day!r}")
    return text


def _suffix_lit(value) -> Column:
    """A literal day, or a Column (e.g. a scalar subquery) as is."""
    return F.lit(value).cast("string")


def daily_filter(start_date, landed_max: str | Column | None) -> Column:
    """Daily branch: 8-digit suffix within [start, last landed day].

    A null ``landed_max`` makes the comparison null, so nothing is kept:
    no landed day gives an empty report.
    """
    suffix = F.col(schemas.SUFFIX)
    return (suffix.rlike(r"^[0-9]{8}$")
            & suffix.between(_suffix_lit(day_text(start_date)), _suffix_lit(landed_max)))


def intraday_filter(landed_max: str | Column | None, as_of) -> Column:
    """Intraday branch: after the last landed day, up to ``as_of``.

    There is no lower start bound and no 8-digit guard here, on purpose.
    """
    suffix = F.col(schemas.SUFFIX)
    return (suffix > _suffix_lit(landed_max)) & (suffix <= _suffix_lit(day_text(as_of)))


def read_shards(spark: SparkSession, base: str) -> DataFrame:
    """Scan a suffix-partitioned event folder with the declared schema."""
    schema = T.StructType(schemas.EVENTS.fields + [T.StructField(schemas.SUFFIX, T.StringType())])
    return (spark.read.schema(schema)
            .option("basePath", base)
            .parquet(base))


def read_daily(spark: SparkSession, base: str, start_date, landed_max: str | None) -> DataFrame:
    return read_shards(spark, base).where(daily_filter(start_date, landed_max))


def read_intraday(spark: SparkSession, base: str, landed_max: str | None, as_of) -> DataFrame:
    return read_shards(spark, base).where(intraday_filter(landed_max, as_of))


def _list_partition_values(spark: SparkSession, base: str) -> list[str]:
    """Names of ``suffix=`` folders under ``base`` (catalog listing, no
    data is read). An empty folder is a landed day."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    out = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(schemas.SUFFIX + "="):
            out.append(name.split("=", 1)[1])
    return out


def landed_max(spark: SparkSession, base: str | None = None, table: str | None = None) -> str | None:
    """Last landed day: the largest 8-digit suffix in the catalog.

    ``table`` reads ``SHOW PARTITIONS`` of a catalog table; ``base`` lists
    the partition folders. Both read metadata only. Returns None when no
    day has landed.
    """
    if table is not None:
        rows = (spark.sql(f"SHOW PARTITIONS {table}")
                .select(F.regexp_extract("partition", rf"{schemas.SUFFIX}=(\d{{8}})$", 1).alias("d"))
                .where(F.col("d") != "")
                .agg(F.max("d").alias("d")).first())
        values = [rows["d"]] if rows and rows["d"] else []
    else:
        values = [v for v in _list_partition_values(spark, base) if _DAY.match(v)]
    if not values:
        log.warning("no landed day found; the report will be empty")
        return None
    return max(values)


def landed_max_from_names(names) -> str | None:
    """Largest ``events_YYYYMMDD`` suffix among table names (others ignored)."""
    days = [m.group(1) for m in (_DAILY_TABLE.match(n) for n in names) if m]
    return max(days) if days else None


def landed_max_of(df: DataFrame) -> str | None:
    """Landed max over a frame that stands in for the catalog (one row per
    landed day at least). Used by the test-table adapter."""
    row = (df.select(schemas.SUFFIX).where(F.col(schemas.SUFFIX).rlike(r"^[0-9]{8}$"))
           .agg(F.max(schemas.SUFFIX).alias("m")).first())
    return row["m"] if row else None


def landed_max_column(df: DataFrame) -> Column:
    """The same as ``landed_max_of`` as a scalar subquery, evaluated inside
    the query that uses it (no separate driver job)."""
    return (df.select(schemas.SUFFIX).where(F.col(schemas.SUFFIX).rlike(r"^[0-9]{8}$"))
            .select(F.max(schemas.SUFFIX)).scalar())


def to_micros(ts) -> int:
    """``'YYYY-MM-DD HH:MM[:SS]'`` (UTC), datetime or microseconds ->
    epoch microseconds."""
    if isinstance(ts, (int,)):
        return ts
    if not isinstance(ts, _dt.datetime):
        ts = _dt.datetime.fromisoformat(str(ts))
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=_dt.timezone.utc)
    delta = ts - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def between_times(events: DataFrame, start=None, end=None) -> DataFrame:
    """Events at ``start`` or later and before ``end``. A shard holds the
    events of its UTC day, so on day shards the days of both ends also
    prune partitions."""
    day = lambda micros: _dt.datetime.fromtimestamp(micros // 1_000_000, _dt.timezone.utc).strftime("%Y%m%d")
    time, has_days = F.col("event_timestamp"), schemas.SUFFIX in events.columns
    if start is not None:
        lo = to_micros(start)
        events = events.where(time >= F.lit(lo))
        events = events.where(F.col(schemas.SUFFIX) >= F.lit(day(lo))) if has_days else events
    if end is not None:
        hi = to_micros(end)
        events = events.where(time < F.lit(hi))
        events = events.where(F.col(schemas.SUFFIX) <= F.lit(day(hi - 1))) if has_days else events
    return events


def union_events(daily: DataFrame, intraday: DataFrame, start_date, landed_max: str | None,
                 as_of, event_names, extra_columns=EXTRA) -> DataFrame:
    """Landed days plus not-yet-landed intraday days, one row set.

    The cut is the last landed day, so no day is scanned twice. Filters
    are written per branch so each reaches its own scan.
    """
    names = list(event_names)
    cols = list(schemas.EVENT_COLUMNS) + [c for c in extra_columns
                                           if c in daily.columns and c in intraday.columns]
    d = (daily.where(daily_filter(start_date, landed_max) & F.col("event_name").isin(names))
         .select(*cols))
    i = (intraday.where(intraday_filter(landed_max, as_of) & F.col("event_name").isin(names))
         .select(*cols))
    return d.unionByName(i)
