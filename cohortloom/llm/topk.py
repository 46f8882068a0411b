"""Operator 12: exact top-k search by columnar branch and bound.

The k candidates of the highest integer inner product for every query.
Components are floor(``SCALE`` x). Candidates are packed in blocks of
``BLOCK`` vectors in vertical layout, a row of a block's matrix per
dimension. A block of queries meets a block of candidates dimension block
by dimension block, those with the most mass first: partial products are
summed for all candidates at once, and the mass that is left of a query and
of a candidate (the norms of their remaining components, whose product
bounds what may still come) tells which candidates can still reach the
query's k-th score so far. The others leave the block's columns before the
next dimension block. Bounds carry a slack above their rounding, sums are
of whole numbers, so the result is exact.

Spark deals the pairs of blocks: queries in groups of ``QUERIES``,
candidates in groups of ``GROUP``, a cell for each pair of groups. Groups
are dealt evenly, not by a key, so no id or vector is hot. A task holds one
group of queries and one block of candidates at a time and returns each
query's k + 1 best of the cell; a window with a partial limit before its
shuffle merges the cells. Block sizes are the same at every input size.

Defined results: a vector that is null, holds a null, a NaN or an infinite
component (also after scaling) takes no part, as query or as candidate;
vectors of different lengths are compared as if padded by zeros (an empty
one scores 0); ties go to the smaller id; a query leaves out its own row
only, so another row of the same id is a candidate, and equal query rows
each have their result; a row with a null id is no query, and a candidate
that loses every tie; scores beyond a long are held at its ends; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm import common as C

SCALE = 64
BLOCK = 2048
GROUP = 8 * BLOCK
QUERIES = 1024
#: Dimensions that are summed between two bounds, and queries that share a compaction.
DIMS = 16
TOGETHER = 32
NO_ID = 2**63 - 1

_PACKED = "deal long, seq long, first long, dims int, kind string, ids binary, vectors binary"
_FOUND = "query long, query_id long, own long, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def _rows(ids: pa.Array, vectors: pa.Array, scale: int):
    """(ids, whole-number matrix) per length of the vectors that take part."""
    ids = ids.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    size = pc.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vectors)
    lost = np.asarray(pc.is_null(flat).to_numpy(zero_copy_only=False), bool)
    with np.errstate(all="ignore"):
        whole = np.floor(flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) * scale)
    bad = lost | ~np.isfinite(whole)
    row = np.repeat(np.arange(len(size)), np.maximum(size, 0))
    good = size >= 0
    good[row[bad]] = False
    for dims in np.unique(size[good]).tolist():
        mine = good & (size == dims)
        yield ids[mine], whole[mine[row]].reshape(int(mine.sum()), dims)


def _pack(scale: int, vertical: bool):
    def run(batches):
        deal, seq, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for ids, m in _rows(batch.column(0), batch.column(1), scale):
                for a in range(0, len(ids), BLOCK):
                    part = m[a:a + BLOCK]
                    kind = "f4" if not part.size or np.abs(part).max() < 2**24 else "f8"
                    body = np.ascontiguousarray((part.T if vertical else part).astype(kind)).tobytes()
                    n = len(part)
                    yield pa.RecordBatch.from_pylist([{
                        "deal": deal, "seq": seq, "first": first, "dims": m.shape[1], "kind": kind,
                        "ids": ids[a:a + n].tobytes(), "vectors": body}], schema=_ARROW)
                    seq, first = seq + 1, first + n
    return run


_ARROW = pa.schema([("deal", pa.int64()), ("seq", pa.int64()), ("first", pa.int64()), ("dims", pa.int32()),
                    ("kind", pa.string()), ("ids", pa.binary()), ("vectors", pa.binary())])


class Queries:
    """Queries of one length and their best candidates so far."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int):
        self.number, self.ids, self.m, self.k = number, ids, m, k
        self.best = np.full((len(ids), k), -np.inf, np.longdouble)
        self.best_id = np.full((len(ids), k), NO_ID, np.int64)

    def meet(self, ids: np.ndarray, c: np.ndarray) -> None:
        """Take the best of a block; ``c`` has a row per dimension."""
        dims = min(self.m.shape[1], len(c))
        q, c = self.m[:, :dims], c[:dims]
        most = dims * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
        # sums of whole numbers below 2^24 and 2^53 are exact in these
        exact = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.longdouble
        wide = np.longdouble if exact is np.longdouble else np.float64
        q2, c2 = q.astype(wide) ** 2, c.astype(wide) ** 2
        order = np.argsort(-(q2.sum(axis=0) * c2.sum(axis=1)), kind="stable")
        q, c, q2, c2 = q[:, order].astype(exact), c[order].astype(exact), q2[:, order], c2[order]
        cuts = list(range(0, dims, DIMS)) + [dims]
        left_q = {d: np.sqrt(q2[:, d:].sum(axis=1)) for d in cuts[1:-1]}
        left_c = {d: np.sqrt(c2[d:].sum(axis=0)) for d in cuts[1:-1]}
        for a in range(0, len(q), TOGETHER):
            part, goal = q[a:a + TOGETHER], self.best[a:a + TOGETHER, -1]
            live, sums = np.arange(c.shape[1]), np.zeros((len(part), c.shape[1]), exact)
            for d0, d1 in zip(cuts[:-1], cuts[1:]):
                sums += part[:, d0:d1] @ (c[d0:d1] if len(live) == c.shape[1] else c[d0:d1, live])
                if d1 < dims and np.isfinite(goal).all():
                    bound = sums + left_q[d1][a:a + TOGETHER, None] * left_c[d1][None, live] * 1.0001 + 2
                    need = (bound >= goal[:, None]).any(axis=0)
                    if need.sum() < 0.8 * len(need):
                        live, sums = live[need], sums[:, need]
            row, col = np.nonzero(sums >= goal[:, None])
            cut = np.searchsorted(row, np.arange(len(part) + 1))
            for i in np.unique(row).tolist():
                mine = col[cut[i]:cut[i + 1]]
                score = np.r_[self.best[a + i], sums[i, mine]]
                name = np.r_[self.best_id[a + i], ids[live[mine]]]
                top = np.lexsort((name, -score))[:self.k]
                self.best[a + i], self.best_id[a + i] = score[top], name[top]

    def found(self) -> pa.RecordBatch:
        row, col = np.nonzero(np.isfinite(self.best))
        m = self.m.astype(np.longdouble)
        own = _long((m * m).sum(axis=1))
        name = self.best_id[row, col]
        return pa.RecordBatch.from_arrays([
            pa.array(self.number[row]), pa.array(self.ids[row]), pa.array(own[row]),
            pa.array(name, mask=name == NO_ID), pa.array(_long(self.best[row, col]))],
            names=["query", "query_id", "own", "vec_id", "score"])


def _long(x: np.ndarray) -> np.ndarray:
    return np.clip(x, np.longdouble(_LONG.min), np.longdouble(_LONG.max)).astype(np.int64)


def _search(k: int):
    """Cells in order, in each the queries and then the candidates' blocks."""
    def run(batches):
        cell, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                deal, grp, is_cand, _, first, dims, kind, ids, body = (batch.column(j)[i].as_py() for j in range(9))
                if cell != (deal, grp):
                    for h in held:
                        yield h.found()
                    cell, held = (deal, grp), []
                ids = np.frombuffer(ids, np.int64)
                m = np.frombuffer(body, kind)
                if is_cand:
                    for h in held:
                        h.meet(ids, m.reshape(dims, len(ids)))
                else:
                    held.append(Queries((np.int64(grp) << 32) + first + np.arange(len(ids)), ids, m.reshape(len(ids), dims), k))
        for h in held:
            yield h.found()
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = SCALE,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates (all, if
    fewer) of every row with ``is_query``, a condition on ``vec_id``."""
    thin = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    chosen = F.col("vec_id").isNotNull() & is_query
    size = thin.agg(F.count("*").alias("n"), F.count_if(chosen).alias("q")).first()
    groups = [max(1, -(-n // at)) for n, at in ((size["q"], QUERIES), (size["n"], GROUP))]
    queries = C.saved(thin.where(chosen).repartition(groups[0]).mapInArrow(_pack(scale, False), _PACKED))
    blocks = thin.repartition(groups[1]).mapInArrow(_pack(scale, True), _PACKED)
    body = ["seq", "first", "dims", "kind", "ids", "vectors"]
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cells = (blocks.select("deal", each(groups[0]).alias("grp"), F.lit(True).alias("is_cand"), *body)
             .union(queries.select(each(groups[1]), F.col("deal"), F.lit(False), *body)))
    found = (cells.repartition("deal", "grp").sortWithinPartitions("deal", "grp", "is_cand", "seq")
             .mapInArrow(_search(k + 1), _FOUND))
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    own = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("place")))
    top = top.withColumn("own_place", F.coalesce(own.over(Window.partitionBy("query")), F.lit(k + 2)))
    rank = F.col("place") - F.when(F.col("own_place") < F.col("place"), 1).otherwise(0)
    return (top.where("place <> own_place").select("query_id", rank.cast("int").alias("rank"), "vec_id", "score")
            .where(F.col("rank") <= k))
