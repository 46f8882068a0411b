"""Materialize a reused intermediate as a table in the shared folder.

The folder is the cluster's ``spark.checkpoint.dir`` (read from the
session; set only when unset, as in tests). Writing once and reading
back computes the input once, cuts its lineage (a lost executor rereads
files instead of recomputing), and gives later stages real statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortloom.session import shared_folder


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
