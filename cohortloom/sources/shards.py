"""Writing and listing of date-sharded event folders.

A listing of files (path, length, change time) reads no file: it is
Spark's own parallel listing of the folder. A day's files are summed up
in one print, so what has been read before is remembered with one row a
day, however many files a day has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.sources import events as E

FILES = "path string, modificationTime timestamp, length long"


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, name: str) -> bool:
    path, fs = _path(spark, name)
    return fs.exists(path)


def write_shards(events: DataFrame, base: str, mode: str = "append") -> None:
    """Events with a ``suffix`` -> ``base/suffix=...``. Rows are dealt by
    day and a large day is split again (rebalance), so a day has few files
    and no task a whole hot day."""
    events.hint("rebalance", schemas.SUFFIX).write.mode(mode).partitionBy(schemas.SUFFIX).parquet(base)


def land_empty(spark: SparkSession, base: str, day) -> None:
    """Land a day without events: its folder alone."""
    path, fs = _path(spark, f"{base}/{schemas.SUFFIX}={E.day_text(day)}")
    fs.mkdirs(path)


def remove(spark: SparkSession, name: str) -> None:
    path, fs = _path(spark, name)
    fs.delete(path, True)


def day_files(spark: SparkSession, base: str) -> DataFrame:
    """(suffix, path, length, modified) of the files below ``base``."""
    if not exists(spark, base):
        files = spark.createDataFrame([], FILES)
    else:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.parquet").load(base))
    suffix = F.regexp_extract("path", rf"/{schemas.SUFFIX}=([^/]+)/[^/]*$", 1)
    return (files.select(suffix.alias(schemas.SUFFIX), "path", "length", F.col("modificationTime").alias("modified"))
            .where(F.col(schemas.SUFFIX) != ""))


def day_prints(files: DataFrame) -> DataFrame:
    """(suffix, n_files, print): equal prints mean equal sets of files."""
    one = F.xxhash64("path", "length", "modified").cast("decimal(38,0)")
    return files.groupBy(schemas.SUFFIX).agg(F.count(F.lit(1)).alias("n_files"), F.sum(one).alias("print"))


def landed_days(spark: SparkSession, base: str) -> DataFrame:
    """(suffix, n_events, is_last) of every landed day of the folder; an
    empty shard is landed with 0 events."""
    days = sorted(d for d in E._list_partition_values(spark, base) if E._DAY.match(d))
    listed = spark.createDataFrame([(d, d == days[-1]) for d in days], "suffix string, is_last boolean")
    held = E.read_shards(spark, base).groupBy(schemas.SUFFIX).agg(F.count(F.lit(1)).alias("n"))
    return (listed.join(held, schemas.SUFFIX, "left")
            .select(schemas.SUFFIX, F.coalesce("n", F.lit(0)).cast("long").alias("n_events"), "is_last"))
