"""Operator 9: mixing sources to target weights by capped water-filling.

A source's size is its number of words. The sources share ``share`` times
all words in proportion to their weights, but none above ``epochs`` times
its own size; what a clamped source cannot take is given to the others by
weight until none is above (one pass over the sources in the order of the
water level that clamps them).

A source then takes whole repetitions, floor(target / size) of each of its
documents, and a seeded part of one more: documents in the order of a
seeded hash, until the words that are left are used up. The document at
the border takes the rest in part, so a source's taken words are its
target rounded down. The order is not sorted as a whole: words are summed
over ``BINS`` hash ranges per source, the running sum finds the range with
the border, and only that range is numbered.

Only SQL functions are used.

Defined results: null text has size 0; null is a source of its own, last
in the order of weights; a source of size 0 has target 0; repeated rows
(equal id and size) follow one another and are mixed row by row; a null id
is an id like any other; extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import n_words, saved

BINS = 4096
SEED = 20240229


def cycled(weights: tuple[float, ...] = (3.0, 1.0, 2.0)) -> Column:
    """Weights repeating over the sources by code point, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))).cast("int") + 1)


def targets(sources: DataFrame, weight: Column, share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """source, source_size, target; one input row per source."""
    all_words = F.sum("source_size").over(Window.partitionBy())
    table = sources.select("source", "source_size", weight.alias("w"), (share * all_words).alias("total"))
    table = table.withColumn("cap", epochs * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # level: what a unit of weight gets if this source and all later ones share the rest
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    table = table.withColumn("level", level)
    over = F.col("cap") < F.col("w") * F.col("level")
    water = F.max(F.when(~over, F.col("level"))).over(Window.partitionBy())
    return table.select("source", "source_size",
                        F.when(over, F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * water)).alias("target"))


def mix(docs: DataFrame, share: float = 1.5, epochs: float = 2.0, weights: tuple[float, ...] = (3.0, 1.0, 2.0),
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """doc_id, size, source, source_size, target, taken per row, and the
    columns named in ``carry`` as a struct ``row``.

    Sources are expected to be far fewer than rows; the plan has one row
    per source, and Spark decides from its size how to join it.
    """
    rest = [F.struct(*carry).alias("row")] if carry else []
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), n_words(F.col(text_col)).alias("size"),
                       F.col(source_col).cast("string").alias("source"), *rest)
    thin = saved(read.select("doc_id", "size", "source"))
    draw = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("size"))
    number = F.pmod(draw, F.lit(BINS))
    sums = saved(thin.groupBy("source", number.alias("bin")).agg(F.sum("size").alias("words")))
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), cycled(weights), share, epochs)
    goal = saved(goal.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                 .otherwise(F.lit(0)))
                 .withColumn("part", F.floor(F.col("target") - F.col("whole") * F.col("source_size"))))
    run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    filled = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    edge = (filled.join(goal.select(F.col("source").alias("s1"), "part"), filled.source.eqNullSafe(F.col("s1")))
            .where(F.col("before") + F.col("words") > F.col("part"))
            .groupBy(F.col("source").alias("s1")).agg(F.min(F.struct("bin", "before")).alias("edge")))
    plan = saved(goal.join(edge, goal.source.eqNullSafe(F.col("s1")), "left").drop("s1")
                 .select(F.col("source").alias("s"), "source_size", "target", "whole", "part",
                         F.coalesce("edge.bin", F.lit(-1)).alias("edge_bin"), F.coalesce("edge.before", F.lit(0)).alias("before")))
    rows = (read if carry else thin).withColumn("draw", draw).withColumn("bin", number)
    rows = rows.join(plan, rows.source.eqNullSafe(plan.s))
    taken = lambda extra: (F.col("whole") * F.col("size") + extra).cast("long").alias("taken")
    columns = ["doc_id", "size", "source", "source_size", "target"]
    tail = ["row"] if carry else []
    clear = rows.where("bin <> edge_bin").select(
        *columns, taken(F.when(F.col("bin") < F.col("edge_bin"), F.col("size")).otherwise(F.lit(0))), *tail)
    inside = (Window.partitionBy("source", "bin").orderBy("draw", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("part") - F.col("before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    border = rows.where("bin = edge_bin").select(
        *columns, taken(F.greatest(F.lit(0), F.least(F.col("size"), left))), *tail)
    return clear.union(border)


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: every row as often as its taken words fill it,
    the one partly taken row of a source counted by halves. A row without
    words stays once."""
    names = docs.columns
    out = mix(docs, carry=names, **options)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(1)).cast("int")
    return out.withColumn("times", times).where("times > 0").select(
        F.explode(F.array_repeat(F.col("row"), F.col("times"))).alias("row")).select("row.*")
