"""Tables dealt by device once, for all jobs that meet on the device.

Assignment status (R-4), funnel (R-5) and payments (R-8) group and join on
the device. Written in buckets of the device id, their tables are read in
that partitioning, and none of these jobs shuffles events or orders again.
The cost is one exchange at the write.

A device's rows lie in one bucket, and a bucket is read by one task, which
adaptive execution cannot split. So the tables hold what the jobs read of
the events only: assignment rows, step hits reduced to one mask per device
and group, and successful orders reduced to one row per device and day
where ``payments.window_orders`` needs them whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators import experiment as X
from cohortloom.operators import funnel as FN

DEVICE = "user_pseudo_id"
#: A join on (device, group) may rest on the partitioning by device alone.
CO_PARTITION = ("spark.sql.requireAllClusterKeysForCoPartition", "false")


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = DEVICE) -> DataFrame:
    """Write ``df`` as the table ``table`` at ``path``, one sorted file a
    bucket, and return it as it is read by later jobs."""
    spark = df.sparkSession
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path).format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def device_tables(spark: SparkSession, events: DataFrame, orders: DataFrame, base: str, prefix: str, buckets: int,
                  cutoff, steps=None) -> dict[str, DataFrame]:
    """Assignment rows, step masks and orders up to ``cutoff``, in buckets
    of the device. Sets ``CO_PARTITION`` in the session."""
    spark.conf.set(*CO_PARTITION)
    kept = {"assign": X.assignment_events(events, cutoff=cutoff),
            "masks": FN.step_masks(events, steps, cutoff=cutoff),
            "orders": orders.where(F.col("order_ts") < F.lit(X.to_micros(cutoff)))}
    return {name: write_bucketed(df, f"{prefix}_{name}", f"{base}/{name}", buckets) for name, df in kept.items()}
