"""Operator 7: longest-processing-time sharding (law ``bytes``).

Documents with equal texts form a group that stays together. The groups,
sorted by size, go to the least-loaded shard through a heap. Groups of one
size are interchangeable, so the driver sees sizes instead of groups: a row
(size, groups, bytes) for every size of 13 significant bits. Below 8,192
bytes that is the exact size; above, groups differ by less than 1/4,096
within a row. There are at most 8,192 such rows and 4,096 more for every
doubling beyond, at any number of groups. What the heap would do with n
groups of one size is found at once: each shard takes groups as long as
its load is below a common level, and the heap hands out the rest.

Which shard a group gets follows from its number among the groups of its
size. Numbers are given in cells of a hash, so a size that a third of all
groups share is not numbered in one task. Shards are joined back by group;
the groups that hold more than 1/``HEAVY`` of all rows (there are at most
``HEAVY``) by broadcast, the others through a shuffle, so copies of one
text are not gathered.

Slots count from 0 within a shard: cells of a document hash are counted,
cell offsets are running sums, and rows are numbered inside their cell, so
neither a shard nor a large group of equal texts is numbered in one task.

Defined results: null texts have no bytes, size 1, and form one group with
empty texts; a null id sorts first in its cell; repeated rows are placed
row by row, in one shard since their texts are equal; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import saved

HEAVY = 4096
CELLS = 4096
SIZE_BITS = 13


def lpt(sizes: list[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(size, groups per shard) for (size, groups, bytes) by longest
    processing time; within one size the groups count with their mean."""
    load = [0] * shards
    out = []
    for size, n, total in sorted(sizes, reverse=True):
        mean = max(1, total // n)

        def started(level):
            """Groups that each shard has taken when its load reaches the level."""
            return [max(0, -((x - level) // mean)) for x in load]

        low, high = min(load), max(load) + mean * n + 1
        while n > 4 * shards and high - low > 1:     # fewer go through the heap alone
            level = (low + high) // 2
            low, high = (level, high) if sum(started(level)) <= n else (low, level)
        taken = started(low)
        heap = [(x + k * mean, s) for s, (x, k) in enumerate(zip(load, taken))]
        heapq.heapify(heap)
        for _ in range(n - sum(taken)):
            x, s = heapq.heappop(heap)
            taken[s] += 1
            heapq.heappush(heap, (x + mean, s))
        load = [x + k * mean for x, k in zip(load, taken)]
        out.append((size, taken))
    return out


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = saved(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.md5(F.encode(text, "utf-8")).alias("grp")))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "grp"), F.lit(CELLS)))
    total = rows.count()
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    groups = (groups.withColumn("low", F.greatest(F.length(F.bin("bytes")) - SIZE_BITS, F.lit(0)))
              .withColumn("class", F.expr("shiftleft(shiftright(bytes, low), low)"))
              .withColumn("draw", F.pmod(F.xxhash64("grp"), F.lit(CELLS))))
    groups = saved(groups.select("grp", "class", "bytes", "draw", (F.col("n") * HEAVY > total).alias("heavy")))
    numbers = groups.groupBy("class", "draw").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    numbers = saved(numbers)
    sizes = numbers.groupBy("class").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    # a bounded number of sizes, see above
    plan = lpt([tuple(r) for r in sizes.collect()], shards)
    ends = spark.createDataFrame([(size, [sum(taken[:s + 1]) for s in range(shards)]) for size, taken in plan], "class long, ends array<long>")
    earlier = Window.partitionBy("class").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    numbers = numbers.select("class", "draw", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("class", "draw").orderBy("grp")
    number = F.row_number().over(own) - 1 + F.col("before")
    placed = (groups.join(numbers, ["class", "draw"]).withColumn("number", number).join(F.broadcast(ends), "class")
              .select("grp", "heavy", F.size(F.filter("ends", lambda e: e <= F.col("number"))).alias("shard")))
    placed = saved(placed)
    heavy = placed.where("heavy").select("grp", F.col("shard").alias("own"))
    put = rows.join(F.broadcast(heavy), "grp", "left")
    put = (put.where("own is not null").withColumnRenamed("own", "shard")
           .unionByName(put.where("own is null").drop("own").join(placed.where("not heavy").drop("heavy"), "grp")))
    cells = put.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "grp")
    return (put.withColumn("k", F.row_number().over(inside) - 1).join(cells, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("k")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
