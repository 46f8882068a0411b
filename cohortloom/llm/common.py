"""Helpers shared by the training-data operators.

Word rules are byte rules: every separator and every letter that is
lower-cased is ASCII, and UTF-8 never uses ASCII bytes inside a longer
character, so scanning the UTF-8 bytes gives the same words as scanning
code points.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"
#: The same class as a Java regular expression.
SPACE_RX = r"[\x20\x09-\x0D]+"

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_P_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_CHUNK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """A new folder path for written tables, below ``spark.checkpoint.dir``.

    Where the setting is absent, only a local master gets a folder of its
    own; on a cluster a machine-local folder would lose rows, so it raises.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and sc.master.startswith("local") and "cluster" not in sc.master:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-ckpt-"))
        base = sc._jsc.sc().getCheckpointDir().get()
    if not base:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(col: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null and empty count 0."""
    body = F.trim(F.coalesce(col, F.lit("")), F.lit(SPACES))
    return F.when(body == "", F.lit(0)).otherwise(F.size(F.split(body, SPACE_RX))).cast("long")


# --- vectorised words -----------------------------------------------------

def byte_table(separators, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(byte map, is-separator flags) for :func:`words`."""
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    sep = np.zeros(256, dtype=bool)
    sep[list(separators)] = True
    return fold, sep


SPACE_WORDS = byte_table([0x20, *range(0x09, 0x0E)])
PLAIN_WORDS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


@functools.cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64)


_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("p", ())) < n:
        size = max(n, _CHUNK_BYTES + (1 << 16))
        for key, base in (("p", _P), ("i", _P_INV)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _powers[key] = np.multiply.accumulate(out)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, row offsets); null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, off, data = col.buffers()
    off = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def row_chunks(off: np.ndarray, limit: int = _CHUNK_BYTES):
    """Row ranges of about ``limit`` bytes; a longer row stands alone."""
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def words(data: np.ndarray, off: np.ndarray, table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, per-row word offsets) of the words of some rows.

    ``off`` holds byte offsets of the rows in ``data``; starts and ends
    are byte positions in ``data``. Words never span two rows.
    """
    fold, sep = table
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    data = fold[data]
    word = ~sep[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cut = off[:-1][off[:-1] < n]
    first[cut] = word[cut]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cut = off[1:][off[1:] > 0] - 1
    last[cut] = word[cut]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    p, inv = _power(n + 1)
    c = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * p[:n], out=c[1:])
    h = mix((c[e] - c[s]) * inv[s] + (e - s).astype(np.uint64))
    return s, e, h, np.searchsorted(s, off)


def shingles(h: np.ndarray, woff: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row offsets) of the k-word shingles of each row.

    A row with 1..k-1 words has its whole sequence as one shingle, a row
    without words has none.
    """
    count = np.diff(woff)
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    off = np.concatenate([[0], np.cumsum(number)])
    row = np.repeat(np.arange(len(count)), number)
    start = woff[:-1][row] + np.arange(off[-1]) - off[:-1][row]
    size = np.minimum(count, k)[row]
    out = mix(h[start] + _U(1)) if len(start) else np.zeros(0, np.uint64)
    for j in range(1, k):
        on = size > j
        if on.all():
            out = mix(out * _U(0x2545F4914F6CDD1D) + h[start + j])
        elif on.any():
            out[on] = mix(out[on] * _U(0x2545F4914F6CDD1D) + h[start[on] + j])
    short = size < k
    if short.any():
        out[short] = mix(out[short] + size[short].astype(np.uint64))
    return out, off


# --- bit filters -----------------------------------------------------------

def bit_filter(df: DataFrame, key: str, bits: int) -> np.ndarray:
    """Words of a 2^bits filter over the low bits of a long column.

    At most 2^(bits - 6) numbers reach the driver, whatever the input. A
    filter only spares rows a shuffle; an exact join always follows it.
    """
    low = df.select(F.col(key).bitwiseAND(F.lit((1 << bits) - 1)).alias("bit"))
    rows = (low.groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("set")).collect())
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for r in rows:
        out[r["word"]] = r["set"] & (2**64 - 1)
    return out


def in_filter(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which unsigned keys may be in the filter."""
    low = keys.astype(np.uint64) & _U(64 * len(words) - 1)
    return (words[low >> _U(6)] >> (low & _U(63))) & _U(1) == 1


def filter_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, set) of a 2^bits filter over the low bits of a long column,
    as a table: at most 2^(bits - 6) rows, whatever the input."""
    low = keys.select(F.col(key).bitwiseAND(F.lit((1 << bits) - 1)).alias("bit"))
    return saved(low.groupBy(F.shiftright("bit", 6).alias("word"))
                 .agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("set")))


def passing(df: DataFrame, key: str, words: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose key may be in the filter. The filter is
    broadcast, which its number of bits bounds (2^20 rows at 26 bits); it
    only spares rows a shuffle."""
    low = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    held = F.expr("(shiftright(set, cast(_low & 63 as int)) & 1) = 1")
    return (df.withColumn("_low", low).withColumn("word", F.shiftright("_low", 6))
            .join(F.broadcast(words), "word").where(held).drop("word", "set", "_low"))


# --- connected components -------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least
    node of its component.

    Alternates the large-star and small-star steps. Each step is a minimum
    per node (combined before the shuffle) and an equi-join, so a node with
    very many neighbours is never gathered in one place, and every round is
    a written table, so a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    cur = saved(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .where("a <> b").distinct())
    mark = None
    while True:
        sym = cur.union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (sym.join(low, "a").where("b > a")
                 .select(F.col("m").alias("a"), "b").where("a <> b").distinct())
        large = saved(large)
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        cur = saved(small.select(F.col("m").alias("a"), "b")
                    .union(small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")))
                    .distinct())
        new = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == new:
            break
        mark = new
    return cur.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        cur.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
