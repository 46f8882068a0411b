"""Linked requirement records that ship together (R-12, JN-12).

A record may depend on another one, that one on a third, and so on. All
records of such a chain or tree ship together, and a cycle is a fault.

Each record walks to the end of its chain by doubling: a round joins every
record with the record it stands at and takes over that one's walk, so
after r rounds it has gone 2^r links or ended. While chains remain, a round
ends some; a round that ends none leaves only records in or before cycles.
These go on until their walk is longer than their number: they stand on
their cycle then, and the least id of the cycle names it. Rounds are
written tables, about log2 of the longest chain of them.

Only the records with links are walked. A popular end that a third of the
records depend on is one row on the other side of a join, which adaptive
execution may split or broadcast; group sums combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import dims
from cohortloom.operators.workflow import normalize_version, pool_clean
from cohortloom.plans.materialize import materialize


def link_ends(records: DataFrame) -> DataFrame:
    """(id, root, depth, in_cycle) of every record (id, depends_on).

    ``root`` is the end of the record's chain, itself without a link, and
    ``depth`` its distance. In a cycle the root is the cycle's least id, as
    it is for chains that run into it, and there is no depth. A link to a
    record that does not exist is no link. An id given twice is one record
    with its least link; null ids are left out."""
    rows = records.where("id is not null").groupBy("id").agg(F.min("depends_on").alias("depends_on"))
    known = rows.select(F.col("id").alias("depends_on"))
    links = rows.join(known, "depends_on", "left_semi")
    # low: the least id walked over, the place reached left out
    walk = materialize(links.select("id", F.col("depends_on").alias("at"), F.lit(1).cast("long").alias("steps"),
                                    F.col("id").alias("low"), F.lit(False).alias("ended")), "walk")
    left, gone = walk.count(), 1
    while left:
        t = walk.select(F.col("id").alias("t_id"), F.col("at").alias("t_at"), F.col("steps").alias("t_steps"),
                        F.col("low").alias("t_low"), F.col("ended").alias("t_ended"))
        go = ~F.col("ended") & F.col("t_id").isNotNull()
        walk = materialize(walk.join(t, F.col("at") == F.col("t_id"), "left").select(
            "id", F.when(go, F.col("t_at")).otherwise(F.col("at")).alias("at"),
            F.when(go, F.col("steps") + F.col("t_steps")).otherwise(F.col("steps")).alias("steps"),
            F.when(go, F.least("low", "t_low")).otherwise(F.col("low")).alias("low"),
            (~go | F.col("t_ended")).alias("ended")), "walk")
        gone *= 2
        rest = walk.where("not ended").count()
        if rest == left and gone > rest:
            break
        left = rest
    out = rows.join(walk, "id", "left_anti").select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"))
    out = (out.union(walk.where("ended").select("id", F.col("at").alias("root"), F.col("steps").alias("depth")))
           .withColumn("in_cycle", F.lit(False)))
    round_ = walk.where("not ended")
    name = round_.select(F.col("id").alias("at"), F.col("low").alias("root"))
    on = round_.select(F.col("at").alias("id")).distinct().withColumn("in_cycle", F.lit(True))
    return out.union(round_.select("id", "at").join(name, "at").join(on, "id", "left").select(
        "id", "root", F.lit(None).cast("long").alias("depth"), F.coalesce("in_cycle", F.lit(False)).alias("in_cycle")))


def ship_groups(pool: DataFrame) -> DataFrame:
    """One row per group of two or more records that ship together: its
    root, records, longest chain, records that are done, app versions (more
    than one cannot ship together; versions of other products are counted
    apart) and whether it holds a cycle."""
    rows = pool_clean(pool).where("id is not null")
    version = normalize_version(F.col("release_version"))
    app = F.col("product") == F.lit(dims.APP_PRODUCT)
    facts = rows.groupBy("id").agg(
        F.bool_and(F.col("status") == F.lit(dims.POOL_DONE_STATUS)).alias("done"), F.max(F.when(app, version)).alias("app_version"))
    joined = facts.join(link_ends(pool.select("id", "depends_on")), "id")
    groups = joined.groupBy("root").agg(
        F.count(F.lit(1)).alias("records"), F.max("depth").alias("longest_chain"), F.count_if("done").alias("done"),
        F.min("app_version").alias("first_app_version"), F.max("app_version").alias("last_app_version"),
        F.bool_or("in_cycle").alias("has_cycle"))
    return groups.where("records > 1").withColumn(
        "one_app_version", F.coalesce(F.col("first_app_version") == F.col("last_app_version"), F.lit(True)))
