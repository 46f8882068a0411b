"""R-2 / R-3: dense country × day matrix, daily totals, JSON payloads.

Input is the R-1 report (days × countries rows), so everything here is
small after R-1's aggregation; still no row passes through the driver.
Densifying uses ``explode`` of the literal country list per day, not a
join, and the latest day is a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dims


def _country_dim(countries) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("sort_no"), F.lit(c).alias("country_code"))
                     for i, c in enumerate(countries)])


def method_days(report: DataFrame, method_start) -> DataFrame:
    """Days present in the report on or after ``method_start``; calendar
    gaps stay gaps."""
    return (report.select("cohort_date").distinct()
            .where(F.col("cohort_date") >= F.lit(str(method_start)).cast("date")))


def _one_row_each(report: DataFrame, fields) -> DataFrame:
    """The report's cells; raises where a (day, country) has several rows,
    which would otherwise fan out."""
    several = F.raise_error(F.lit("the report has several rows for a day and country")).cast("boolean")
    return (report.groupBy("cohort_date", "country_code")
            .agg(F.count(F.lit(1)).alias("rows"), *[F.max(f).alias(f) for f in fields])
            .where(F.when(F.col("rows") == 1, F.lit(True)).otherwise(several)).drop("rows"))


def method_matrix_tall(report: DataFrame, method_start=dims.DEFAULT_METHOD_START,
                       countries=None, fields=None) -> DataFrame:
    """One row per (country, day) over the fixed country list × report
    days from ``method_start``; missing cells are 0. Countries outside
    the list are not shown."""
    cs = list(countries or dims.MATRIX_COUNTRIES)
    fs = list(fields or dims.MATRIX_FIELDS)
    grid = (method_days(report, method_start)
            .select("cohort_date", F.explode(_country_dim(cs)).alias("c"))
            .select("cohort_date", "c.sort_no", "c.country_code"))
    cells = _one_row_each(report, fs)
    joined = grid.join(cells, ["cohort_date", "country_code"], "left")
    return joined.select("country_code", "sort_no", "cohort_date",
                         *[F.coalesce(F.col(f).cast("bigint"), F.lit(0).cast("bigint")).alias(f) for f in fs])


def method_matrix_array(report: DataFrame, method_start=dims.DEFAULT_METHOD_START,
                        countries=None, fields=None) -> DataFrame:
    """Per country of the fixed list, the days in order, each an array of
    the 8 values; a country gets an empty list when no day qualifies."""
    cs = list(countries or dims.MATRIX_COUNTRIES)
    fs = list(fields or dims.MATRIX_FIELDS)
    tall = method_matrix_tall(report, method_start, cs, fs)
    per_country = (tall.groupBy("country_code")
                   .agg(F.sort_array(F.collect_list(F.struct("cohort_date", F.array(*fs).alias("v"))))
                        .alias("cells")))
    dim = report.sparkSession.createDataFrame(list(enumerate(cs)), "sort_no int, country_code string")
    return (F.broadcast(dim).join(per_country, "country_code", "left")
            .select("country_code", "sort_no",
                    F.coalesce(F.transform("cells", lambda x: x["v"]),
                               F.array().cast("array<array<bigint>>")).alias("values")))


def day_label(day: Column, latest: Column) -> Column:
    """``MM-dd`` of the day (the year is dropped), ``*`` on the latest day."""
    return F.concat(F.date_format(day, "MM-dd"),
                    F.when(day == latest, F.lit(dims.PARTIAL_DAY_MARK)).otherwise(F.lit("")))


def daily_totals(report: DataFrame, fields=None) -> DataFrame:
    """Sums over all countries per day; the latest day is always marked
    partial. Not cut by ``method_start``."""
    fs = list(fields or dims.TOTAL_FIELDS)
    latest = report.select(F.max("cohort_date")).scalar()
    totals = report.groupBy("cohort_date").agg(*[F.sum(F.col(f).cast("bigint")).alias(f) for f in fs])
    return totals.select("cohort_date", day_label(F.col("cohort_date"), latest).alias("d"),
                         (F.col("cohort_date") == latest).alias("is_partial"),
                         F.col("first_opens").alias("n"), F.col("registered").alias("s"),
                         F.col("android_first_opens").alias("an"), F.col("android_registered").alias("as"))


def payloads(report: DataFrame, method_start=dims.DEFAULT_METHOD_START, countries=None) -> DataFrame:
    """The three hand-over payloads as compact JSON text, one row each:
    day labels, country matrix, daily totals."""
    latest = report.select(F.max("cohort_date")).scalar()
    labels = (method_days(report, method_start)
              .select("cohort_date", day_label(F.col("cohort_date"), latest).alias("label"))
              .agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("cohort_date", "label"))),
                                         lambda x: x["label"])).alias("payload"))
              .select(F.lit("AUTH_METHOD_DAYS").alias("name"), "payload"))
    matrix = (method_matrix_array(report, method_start, countries)
              .agg(F.to_json(F.map_from_entries(F.transform(
                  F.sort_array(F.collect_list(F.struct("sort_no", "country_code", "values"))),
                  lambda x: F.struct(x["country_code"], x["values"])))).alias("payload"))
              .select(F.lit("AUTH_METHOD_DATA").alias("name"), "payload"))
    daily = (daily_totals(report)
             .agg(F.to_json(F.transform(F.sort_array(F.collect_list(
                 F.struct("cohort_date", "d", "n", "s", "an", "as"))),
                 lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"), x["s"].alias("s"),
                                    x["an"].alias("an"), x["as"].alias("as")))).alias("payload"))
             .select(F.lit("REG_DAILY").alias("name"), "payload"))
    return labels.unionByName(matrix).unionByName(daily)
