"""R-8: production orders after assignment and mature 7-day payment rate.

Orders join stable devices on the device id with the time window as a
residual condition. Both sides shuffle on the device id; a device with
a third of all orders is split by adaptive skew-join handling (inner
join, so either side may be split), and the per-device aggregate after
the join combines map-side. The split needs both join inputs to be
shuffle stages: a caller with such a device passes a written device table
rather than the assignment aggregate itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.sources.events import to_micros

DAY_MICROS = 86_400_000_000
MONEY = "decimal(38,2)"


def device_orders(stable: DataFrame, orders: DataFrame, cutoff, days: int = dims.MATURITY_DAYS,
                  success: str = dims.ORDER_SUCCESS) -> DataFrame:
    """One row per stable device: maturity, 7-day paid flag, orders and revenue.

    Mature: ``first_ts + days <= cutoff``. Paid within 7 days: a SUCCESS
    order at ``first_ts <= order_ts < first_ts + days``. Totals count
    SUCCESS orders from assignment to the cutoff.
    """
    hi = to_micros(cutoff)
    span = days * DAY_MICROS
    dev = stable.select("user_pseudo_id", "grp", "country_code", "first_ts")
    ok = (orders.where((F.col("status") == F.lit(success)) & (F.col("order_ts") < F.lit(hi)))
          .select("user_pseudo_id", "order_ts", "amount"))
    j = (ok.join(dev.select("user_pseudo_id", "first_ts"), "user_pseudo_id", "inner")
         .where(F.col("order_ts") >= F.col("first_ts")))
    in7 = F.col("order_ts") < F.col("first_ts") + F.lit(span)
    per_dev = (j.groupBy("user_pseudo_id")
               .agg(F.count_if(in7).alias("orders_7d"),
                    F.sum(F.when(in7, F.col("amount"))).alias("revenue_7d"),
                    F.count(F.lit(1)).alias("orders"),
                    F.sum("amount").alias("revenue")))
    zero = F.lit(0).cast(MONEY)
    return (dev.join(per_dev, "user_pseudo_id", "left")
            .select("user_pseudo_id", "grp", "country_code", "first_ts",
                    ((F.col("first_ts") + F.lit(span)) <= F.lit(hi)).alias("is_mature"),
                    F.coalesce(F.col("orders_7d"), F.lit(0).cast("bigint")).alias("orders_7d"),
                    F.coalesce(F.col("revenue_7d").cast(MONEY), zero).alias("revenue_7d"),
                    F.coalesce(F.col("orders"), F.lit(0).cast("bigint")).alias("orders"),
                    F.coalesce(F.col("revenue").cast(MONEY), zero).alias("revenue")))


def window_orders(stable: DataFrame, orders: DataFrame, cutoff, days: int = dims.MATURITY_DAYS,
                  success: str = dims.ORDER_SUCCESS) -> DataFrame:
    """Orders and revenue of each stable device's first ``days`` days, for
    devices with very many orders (JN-7 as a range join in day cells).

    A device's window touches at most days + 1 calendar days. It becomes one
    row for each, and orders meet it on (device, day), so orders outside the
    window meet nothing and a device's orders are dealt out by day."""
    hi, span = to_micros(cutoff), days * DAY_MICROS
    dev = stable.select("user_pseudo_id", "first_ts")
    cell = lambda c: F.floor(c / F.lit(DAY_MICROS)).cast("long")
    cells = dev.select("*", F.explode(F.sequence(cell(F.col("first_ts")), cell(F.col("first_ts") + F.lit(span - 1)))).alias("day"))
    ok = (orders.where((F.col("status") == F.lit(success)) & (F.col("order_ts") < F.lit(hi)))
          .select("user_pseudo_id", "order_ts", "amount", cell(F.col("order_ts")).alias("day")))
    inside = (F.col("order_ts") >= F.col("first_ts")) & (F.col("order_ts") < F.col("first_ts") + F.lit(span))
    sums = (ok.join(cells, ["user_pseudo_id", "day"]).where(inside).groupBy("user_pseudo_id")
            .agg(F.count(F.lit(1)).alias("orders_7d"), F.sum("amount").cast(MONEY).alias("revenue_7d")))
    return dev.join(sums, "user_pseudo_id", "left").select(
        "user_pseudo_id", F.coalesce("orders_7d", F.lit(0)).cast("long").alias("orders_7d"),
        F.coalesce("revenue_7d", F.lit(0).cast(MONEY)).alias("revenue_7d"))


def mature_rate(dev_orders: DataFrame, all_label: str = dims.ALL_COUNTRIES) -> DataFrame:
    """North-star metric per group and country (plus "all"): share of
    mature devices with a SUCCESS order within 7 days."""
    agg = (dev_orders.where(F.col("is_mature"))
           .groupingSets([["grp", "country_code"], ["grp"]], "grp", "country_code")
           .agg(F.count(F.lit(1)).alias("mature_devices"),
                F.count_if(F.col("orders_7d") > 0).alias("paid_7d"),
                F.grouping_id().alias("gid")))
    return agg.select("grp",
                      F.when(F.col("gid") > 0, F.lit(all_label)).otherwise(F.col("country_code")).alias("country_code"),
                      "mature_devices", "paid_7d",
                      F.round(F.try_divide(F.col("paid_7d").cast("double"),
                                           F.col("mature_devices").cast("double")), 6).alias("paid_rate_7d"))


def order_totals(dev_orders: DataFrame) -> DataFrame:
    """Business metric per group: SUCCESS orders and revenue after
    assignment, kept apart from checkout starts."""
    return (dev_orders.groupBy("grp")
            .agg(F.count(F.lit(1)).alias("devices"),
                 F.count_if(F.col("orders") > 0).alias("paying_devices"),
                 F.sum("orders").alias("success_orders"),
                 F.sum("revenue").cast(MONEY).alias("revenue")))


def verdict_state(metrics: DataFrame, completeness: DataFrame, dev_orders: DataFrame) -> DataFrame:
    """Review order per (group, country): sample size first, then version
    completeness, then 7-day maturity; only then comparable."""
    sample = (metrics.where(F.col("step_no") == 1)
              .select("grp", "country_code", "small_sample"))
    # a found gap holds back its own group; a listed known gap is only marked
    gaps = completeness.groupBy("grp").agg(F.bool_or(F.col("is_gap") & ~F.col("is_known_gap")).alias("has_gap"))
    mature = (dev_orders.groupingSets([["grp", "country_code"], ["grp"]], "grp", "country_code")
              .agg(F.count_if(F.col("is_mature")).alias("mature_devices"), F.grouping_id().alias("gid"))
              .select("grp", F.when(F.col("gid") > 0, F.lit(dims.ALL_COUNTRIES))
                      .otherwise(F.col("country_code")).alias("country_code"), "mature_devices"))
    state = (F.when(F.col("small_sample"), F.lit("small_sample"))
             .when(F.coalesce(F.col("has_gap"), F.lit(False)), F.lit("version_gap"))
             .when(F.coalesce(F.col("mature_devices"), F.lit(0)) == 0, F.lit("immature"))
             .otherwise(F.lit("comparable")))
    return (sample.join(mature, ["grp", "country_code"], "left").join(gaps, "grp", "left")
            .select("grp", "country_code", "small_sample",
                    F.coalesce(F.col("mature_devices"), F.lit(0).cast("bigint")).alias("mature_devices"),
                    state.alias("verdict_state")))
