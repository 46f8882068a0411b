"""Plan checks over every registered job."""

from __future__ import annotations

import pytest

from cohortloom.plans.registry import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + qe.optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_no_cross_join(spark, name):
    plan = _plan(REGISTRY[name](spark, SF))
    for word in FORBIDDEN:
        assert word not in plan, f"{name}: {word}"


def test_first_row_per_device_combines_map_side(spark):
    df = REGISTRY["signup_daily"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "partial_count" in plan


def test_funnel_masks_are_hash_aggregated(spark):
    df = REGISTRY["funnel_reach"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan


def test_hot_device_orders_join_is_split(spark, scratch):
    import contextlib
    import io

    from pyspark.sql import functions as F

    from cohortloom.operators import payments
    from cohortloom.plans.materialize import materialize

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ids = spark.range(60_000)
        user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string")))
        orders = ids.select(user.alias("user_pseudo_id"), F.col("id").alias("order_id"),
                            (F.col("id") * 7919 % 1_000_003).alias("order_ts"), F.lit("SUCCESS").alias("status"),
                            (F.col("id") % 997).cast("decimal(18,2)").alias("amount"))
        stable = materialize(orders.select("user_pseudo_id").distinct()
                             .select("user_pseudo_id", F.lit("A").alias("grp"), F.lit("VN").alias("country_code"),
                                     F.lit(0).cast("bigint").alias("first_ts")), "test-devices")
        df = payments.device_orders(stable, orders, "1970-01-02 00:00:00")
        rows = {r["user_pseudo_id"]: r["orders"] for r in df.collect()}
        assert rows["hot"] == 20_000
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_only_listed_dimensions_are_hinted(spark):
    from cohortloom.plans.broadcast import dimension

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000)

        def physical(df):
            return df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in physical(big.join(dimension(spark, spark.range(50), "id long"), "id"))
        dim = dimension(spark, [(1, "a"), (2, "b")], "id long, v string")
        assert "BroadcastHashJoin" in physical(big.join(dim, "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_report_reads_each_shard_once_and_joins_nothing(spark):
    from tests.event_rows import ev, events_df

    from cohortloom.operators import signup

    shards = events_df(spark, [ev("first_open", "2024-01-05", "10:00", "u")])     # no adapter, whose parameters are joined in
    df = signup.signup_country_method_daily(shards, shards, "2024-01-01", "20240105", "2024-01-31", ordered=False)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Union") == 1 and plan.count("Relation") + plan.count("LogicalRDD") == 2


def test_cutoff_prunes_shards(spark, scratch):
    from tests.event_rows import ev, events_df

    from cohortloom.operators import funnel
    from cohortloom.sources.events import read_shards

    rows = [ev("first_open", f"2024-01-{d:02d}", "10:00", f"u{d}") for d in range(1, 20)]
    events_df(spark, rows).write.partitionBy("suffix").parquet(scratch + "/shards")
    masks = funnel.step_masks(read_shards(spark, scratch + "/shards"), cutoff="2024-01-10 00:00:00")
    assert masks.select("user_pseudo_id").distinct().count() == 9
    filters = [x for x in masks._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x]
    assert filters and all("suffix" in x.split("PartitionFilters:")[1].split("]")[0] for x in filters)


def test_appended_files_are_seen(spark, scratch):
    from cohortloom.sources import fixtures as FX

    src = spark.read.parquet(f"{SF}/events.parquet")
    src.write.parquet(scratch + "/events.parquet")
    n = FX.app_events(spark, scratch).count()
    src.write.mode("append").parquet(scratch + "/events.parquet")
    assert FX.app_events(spark, scratch).count() == 2 * n
