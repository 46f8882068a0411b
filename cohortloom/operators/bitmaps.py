"""Distinct devices that can be merged: per-day bitmaps (AG-16, AG-22).

A count of distinct devices cannot be added up over days. A bitmap per
(day, key) can: bits of device numbers are or-ed, and the count of the
result is exact. When a day is restated, its own bitmaps are built again
and all others stay as they are; no other day's events are read.

Devices get whole numbers from a dictionary that only grows, dense within
``CELLS`` hash cells, so a bitmap of 32 768 bits holds about as many
devices once a cell has that many. Numbers are given in one window per
cell over new devices only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.sources import shards as H

CELLS = 64
_CELL_SIZE = 1 << 40
NUMBERS = "user_pseudo_id string, number long"


def known_devices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(NUMBERS).parquet(path) if H.exists(spark, path) else spark.createDataFrame([], NUMBERS)


def number_devices(events: DataFrame, path: str, cells: int = CELLS) -> DataFrame:
    """Append the events' new devices to the dictionary at ``path`` and
    return it. Null devices have no number."""
    spark = events.sparkSession
    known = known_devices(spark, path)
    cell = F.pmod(F.xxhash64("user_pseudo_id"), F.lit(cells))
    new = (events.select("user_pseudo_id").where("user_pseudo_id is not null").distinct()
           .join(known, "user_pseudo_id", "left_anti").withColumn("cell", cell))
    top = known.groupBy(cell.alias("cell")).agg((F.max("number") % _CELL_SIZE).alias("top"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("user_pseudo_id"))
    # numbers start at 1 in each cell
    rows = new.join(top, "cell", "left").select(
        "user_pseudo_id", (F.col("cell") * _CELL_SIZE + F.coalesce("top", F.lit(0)) + place).alias("number"))
    rows.write.mode("append").parquet(path)
    return known_devices(spark, path)


def day_bitmaps(events: DataFrame, numbers: DataFrame, keys: list[str]) -> DataFrame:
    """(suffix, <keys>, bucket, bits): the devices of each day and key."""
    seen = events.select(schemas.SUFFIX, *keys, "user_pseudo_id").distinct().join(numbers, "user_pseudo_id")
    return (seen.groupBy(schemas.SUFFIX, *keys, F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def restate_days(events: DataFrame, state: str, keys: list[str], days: list[str]) -> None:
    """Build the bitmaps of ``days`` (names, e.g. from
    ``sources.restate.refresh_days``) again from their events. Other days'
    files are not touched, and their events are not read."""
    spark = events.sparkSession
    own = events.where(F.col(schemas.SUFFIX).isin(list(days)))
    numbers = number_devices(own, f"{state}/devices")
    for day in days:           # a day that has lost all its events has no bitmaps to write
        H.remove(spark, f"{state}/bitmaps/{schemas.SUFFIX}={day}")
    (day_bitmaps(own, numbers, keys).write.mode("append").partitionBy(schemas.SUFFIX).parquet(f"{state}/bitmaps"))


def read_bitmaps(spark: SparkSession, state: str) -> DataFrame:
    return spark.read.parquet(f"{state}/bitmaps").withColumn(schemas.SUFFIX, F.col(schemas.SUFFIX).cast("string"))


def distinct_devices(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Exact distinct devices per ``keys``, some or all of the bitmaps'
    own keys, over the days that the frame holds."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("devices"))
