"""Operator 1: near-duplicate documents by b-bit MinHash.

A document is the set of its distinct k-word shingles (ASCII letters
lower-cased, words split at ASCII white space; a text with fewer words is
one shingle, a text without words is the empty set and links to nothing).
Two documents are linked when their sets' Jaccard similarity is at least
the threshold; groups are the connected components of the links.

Steps
 1. One pass over the texts: 128 minima per document. 32 band keys of
    four minima each find candidates; the low four bits of every minimum
    are packed as eight longs (two per bit plane) and kept as signature.
 2. Documents with equal sets form one class (128-bit set hash); only
    classes go on, so copies cost one row each.
 3. Star pass: inside a band bucket every class is paired with one centre
    only, the class with most bucket neighbours over all bands. Pairs whose
    collision-corrected similarity (bit counts of the xor-ed planes) is
    clearly below the threshold are dropped, the rest is confirmed on the
    full sets. Components of these links are found.
 4. Rest pass: buckets that still hold several components are joined with
    themselves, for members of different components only: every member
    meets those outside the bucket's largest component, so a bucket with one
    large group of copies costs its rows times the few others. The join
    tests size, signature, and a finer signature of 2,048 minima that only
    these classes get, so no true link between components is lost and a
    bucket of copies never becomes all its pairs. What passes is confirmed
    on the full sets.

At similarity 0.8 a pair misses all 32 bands with probability 5e-8; the
signature test cuts 4.9 standard errors below the threshold.

Defined results: null text = empty set; a row whose id is null is returned
with its own set size, component null and kept true; rows that share an id
and a text are one document; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import common as C

#: Minima and bands for whole documents; at most HASHES and BANDS of them.
HASHES, BANDS, BITS, ROWS = 128, 32, 4, 4
#: Minima and bits of the fine signature that stands before the full sets.
FINE, FINE_BITS = 2048, 2
#: Size of the filter that finds candidates' texts: 2 MB.
FILTER_BITS = 24
#: Size of the filters of band keys and of classes with candidates: 8 MB, as tables.
KEY_BITS = 26
_rng = np.random.default_rng(7919)
_XOR = _rng.integers(0, 2**64, FINE, dtype=np.uint64)
_MUL = _rng.integers(0, 2**63, FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 2**64, BANDS, dtype=np.uint64)
_U = np.uint64

_SIG = "n_shingles long, cls binary, planes array<bigint>, bands array<bigint>, n_words long"


def _sets(col, k, whole=True):
    """Per chunk of rows: (row range, distinct shingles, offsets, words).
    Without ``whole`` a row of fewer than k words has no shingle."""
    data, off = C.text_bytes(col)
    for a, b in C.row_chunks(off):
        _, _, h, woff = C.words(data[off[a]:off[b]], off[a:b + 1] - off[a], C.SPACE_WORDS)
        sh, soff = C.shingles(h, woff, k)
        n = np.diff(woff)
        own = [np.unique(sh[soff[i]:soff[i + 1]]) if whole or n[i] >= k else sh[:0] for i in range(b - a)]
        yield a, b, np.concatenate(own) if own else sh, np.concatenate([[0], np.cumsum([len(x) for x in own])]), n


def _class(u, off):
    """16-byte set hash per row; ``off`` without empty rows."""
    one = np.add.reduceat(C.mix(u), off) + (np.diff(np.append(off, len(u)))).astype(np.uint64)
    two = np.add.reduceat(C.mix(u ^ _U(0xA5A5A5A55A5A5A5A)), off)
    return np.stack([C.mix(one), C.mix(two + one)], axis=1)


def _minima(u, off, hashes):
    out = np.empty((hashes, len(off)), dtype=np.uint64)
    for j in range(hashes):
        out[j] = np.minimum.reduceat((u ^ _XOR[j]) * _MUL[j], off)
    return out


def _packed(low, bits):
    """The low bits of the minima, one row of longs per plane and document."""
    return np.concatenate([np.packbits(np.ascontiguousarray(((low >> _U(j)) & _U(1)).astype(np.uint8).T), axis=1).view(np.int64)
                           for j in range(bits)], axis=1)


def _signatures(k, bands_used, whole):
    hashes = bands_used * ROWS
    half = hashes // 64

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b, u, off, n_words in _sets(texts, k, whole):
                n = np.diff(off)
                full = n > 0
                at = off[:-1][full]
                cls = np.zeros((b - a, 16), np.uint8)
                planes = np.zeros((b - a, half * BITS), np.int64)
                bands = np.zeros((b - a, bands_used), np.int64)
                if len(at):
                    cls[full] = _class(u, at).view(np.uint8).reshape(-1, 16)
                    low = _minima(u, at, hashes)
                    planes[full] = _packed(low, BITS)
                    key = low.reshape(bands_used, ROWS, -1)
                    x = key[:, 0]
                    for r in range(1, ROWS):
                        x = C.mix(x) + key[:, r]
                    bands[full] = np.ascontiguousarray(C.mix(x + _BAND[:bands_used, None]).T).view(np.int64)
                none = pa.array(~full)
                raw = pa.Array.from_buffers(pa.binary(16), b - a, [None, pa.py_buffer(cls.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(a, b - a), pa.array(n),
                    pa.compute.if_else(none, pa.scalar(None, pa.binary()), raw),
                    pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * half * BITS, half * BITS, dtype=np.int32), planes.ravel()),
                    pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * bands_used, bands_used, dtype=np.int32), bands.ravel()),
                    pa.array(n_words.astype(np.int64)),
                ], names=["doc_id", "n_shingles", "cls", "planes", "bands", "n_words"])
    return run


def _full_sets(k, with_fine, wanted):
    def run(batches):
        for batch in batches:
            asked = C.in_filter(wanted, batch.column(0).to_numpy().view(np.uint64))
            for a, b, u, off, _ in _sets(batch.column(1).filter(pa.array(asked)), k):
                n = np.diff(off)
                full = np.flatnonzero(n > 0)
                if not len(full):
                    continue
                at = off[:-1][full]
                cls = _class(u, at).view(np.uint8).reshape(-1, 16)
                # a few documents at a time, so their minima stay small
                fine = np.zeros((len(at), 0), np.int64) if not with_fine else np.concatenate([_packed(_minima(u[at[i]:at[i + 64] if i + 64 < len(at) else None], at[i:i + 64] - at[i], FINE), FINE_BITS)
                                       for i in range(0, len(at), 64)])
                width = fine.shape[1]
                yield pa.RecordBatch.from_arrays([
                    pa.array([c.tobytes() for c in cls], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * width, fine.ravel()),
                    pa.array([u[x:x + y].tobytes() for x, y in zip(at, n[full])], pa.binary()),
                ], names=["cls", "fine", "members"])
    return run


def _confirm(percent):
    def run(batches):
        for batch in batches:
            one, two = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(one[i].as_buffer(), np.uint64)
                y = np.frombuffer(two[i].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _estimate(x: str, y: str, hashes: int, bits: int = BITS):
    """Collision-corrected similarity of two packed signatures."""
    apart, parts = F.lit(0), hashes // 64
    for part in range(parts):
        differ = F.lit(0).cast("long")
        for j in range(bits):
            differ = differ.bitwiseOR(F.col(x)[parts * j + part].bitwiseXOR(F.col(y)[parts * j + part]))
        apart = apart + F.bit_count(differ)
    chance = 2.0**-bits
    return ((hashes - apart) / F.lit(float(hashes)) - chance) / (1 - chance)


def _cut(percent: int, hashes: int, bits: int = BITS) -> float:
    """What an estimate must reach: 4.9 standard errors below the threshold."""
    chance = 2.0**-bits
    equal = chance + (1 - chance) * percent / 100
    return percent / 100 - 4.9 * (equal * (1 - equal) / hashes)**0.5 / (1 - chance)


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
          percent: int = 80, bands: int = BANDS, whole: bool = True, rows_of=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, links between classes).

    documents: doc_id, n_shingles, cls, n_words; classes: cls, doc_id (least id);
    links: a, b. Every component of the full link graph is a component of
    the returned links. Ids may be of any type with an order. ``bands``
    bands of four minima are used; a multiple of 16. Without ``whole`` a
    text of fewer words than a shingle links to nothing. ``rows_of(ids)``
    gives at least the rows (id, text) of some ids where that is cheaper
    than to make all of them again.
    """
    hashes = bands * ROWS
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    sigs = C.saved(read.mapInArrow(_signatures(shingle, bands, whole), f"doc_id {kind}, {_SIG}"))
    documents = sigs.select("doc_id", "n_shingles", "cls", "n_words")
    known = sigs.where("cls is not null and doc_id is not null")
    classes = C.saved(known.groupBy("cls").agg(F.min("doc_id").alias("doc_id")))
    # band keys that occur once are most of all; they are counted as bare
    # numbers, and only what the filter of the others lets through is shuffled
    keys = known.select(F.explode("bands").alias("key"))
    often = C.filter_words(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key", KEY_BITS)
    entry = C.passing(known.select("cls", F.posexplode("bands").alias("band", "key")), "key", often, KEY_BITS).distinct()
    entry = C.saved(entry)
    shared = entry.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = C.saved(entry.join(shared, ["band", "key"]))
    need = C.filter_words(members.select(F.xxhash64("cls").alias("tag")), "tag", KEY_BITS)
    first = F.struct("doc_id", "n_shingles", "planes", "bands")
    reps = C.saved(C.passing(known.withColumn("tag", F.xxhash64("cls")), "tag", need, KEY_BITS)
                   .groupBy("cls").agg(F.min(first).alias("x")).select("cls", "x.doc_id", "x.n_shingles", "x.planes", "x.bands"))
    # the star's centre is the member with most neighbours over all bands: the text that others were made from
    degree = members.groupBy("cls").agg(F.sum("n").alias("degree"))
    central = members.join(degree, "cls").groupBy("band", "key").agg(F.min(F.struct(-F.col("degree"), "cls")).alias("x"))
    members = C.saved(members.drop("n").join(central.select("band", "key", F.col("x.cls").alias("head")), ["band", "key"]))

    def full_sets(need, fine):
        """cls, fine signature, members of the classes in ``need``."""
        ids = C.saved(need.join(classes, "cls").select("doc_id", F.xxhash64("doc_id").alias("tag")))
        wanted = C.bit_filter(ids, "tag", FILTER_BITS)  # most texts stay where they are
        some = rows_of(ids).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) if rows_of else read
        return C.saved(some.where("doc_id is not null").select(F.xxhash64("doc_id").alias("tag"), "text")
                       .mapInArrow(_full_sets(shingle, fine, wanted), "cls binary, fine array<bigint>, members binary")
                       .join(need, "cls", "left_semi").dropDuplicates(["cls"]))

    def confirmed(pairs, sets):
        """Pairs (a, b) that hold on the full sets."""
        both = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("one")), "a")
                .join(sets.select(F.col("cls").alias("b"), F.col("members").alias("two")), "b").select("a", "b", "one", "two"))
        return C.saved(both.mapInArrow(_confirm(percent), "a binary, b binary"))

    def alike():
        return ((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                & (_estimate("pa", "pb", hashes) >= _cut(percent, hashes)))

    thin = reps.select("cls", "n_shingles", "planes")
    star = members.where("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b")).distinct()
    star = C.saved(star.join(thin.toDF("a", "na", "pa"), "a").join(thin.toDF("b", "nb", "pb"), "b").where(alike()).select("a", "b"))
    tried = star.select(F.col("a").alias("cls")).union(star.select(F.col("b").alias("cls"))).distinct()
    found = confirmed(star, full_sets(tried, False))

    root = C.components(found)
    placed = members.join(root.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    parts = placed.groupBy("band", "key", "root").agg(F.count("*").alias("n"))
    mixed = (parts.groupBy("band", "key").agg(F.max(F.struct("n", "root")).alias("x"), F.count("*").alias("roots"), F.sum("n").alias("n"))
             .where("roots > 1 and n > 2").select("band", "key", F.col("x.root").alias("largest")))
    rest = C.saved(placed.join(mixed, ["band", "key"]).where("cls <> head")
                   .select("band", "key", "cls", "root", (F.col("root") != F.col("largest")).alias("outside")))
    sets = full_sets(rest.select("cls").distinct(), True)
    wide = rest.join(reps.drop("doc_id"), "cls").join(sets.select("cls", "fine"), "cls")
    x, y = (wide.select("band", "key", F.col("cls").alias(m), F.col("root").alias("r" + m), F.col("n_shingles").alias("n" + m),
                        F.col("planes").alias("p" + m), F.col("bands").alias("k" + m), F.col("fine").alias("f" + m), F.col("outside").alias("o" + m))
            for m in "ab")
    # a pair counts in the first band it shares only
    earlier = F.exists(F.arrays_zip(F.slice("ka", 1, x.band).alias("l"), F.slice("kb", 1, x.band).alias("r")), lambda z: z["l"] == z["r"])
    # one of two components is not the bucket's largest, so only the members outside that stand on the second side
    pairs = x.join(y.where("ob"), (x.band == y.band) & (x.key == y.key) & (F.col("ra") != F.col("rb"))
                   & (~F.col("oa") | (F.col("a") < F.col("b"))) & alike() & (_estimate("fa", "fb", FINE, FINE_BITS) >= _cut(percent, FINE, FINE_BITS)) & ~earlier)
    return documents, classes, found.union(confirmed(C.saved(pairs.select("a", "b")), sets))


def _grouped(read: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id (least id of the group), kept."""
    documents, classes, edges = links(read, "doc_id", "text", shingle, percent)
    root = C.components(edges)
    placed = classes.join(root.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    low = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    home = C.saved(placed.join(low, "root").select("cls", "component_id"))
    out = documents.join(home, "cls", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def near_dups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
              percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per input row."""
    return _grouped(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), shingle, percent)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near copies, columns unchanged.

    Of a group the row with the least (id, text digest) stays, a null id
    first. Rows equal in id and text are one row, the least by all columns.
    """
    key = F.struct(F.col(id_col).alias("id"), F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("digest"))
    kept = _grouped(docs.select(key.alias("doc_id"), F.col(text_col).alias("text")), shingle, percent).where("kept")
    kept = C.saved(kept.select("doc_id.id", "doc_id.digest").distinct())
    rows = docs.select(F.struct("*").alias("row"), key.alias("key")).select("row", "key.digest", F.col("key.id").alias("own"))
    rows = rows.join(kept, (rows.digest == kept.digest) & rows.own.eqNullSafe(kept.id), "left_semi")
    return rows.groupBy("digest", "own").agg(F.min("row").alias("row")).select("row.*")
