"""Corpus pipeline: documents to shards of a training mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's
input. All stages but the last return the columns of ``documents``.

Defined results: rows without words (null and empty texts) fail the quality
rules. A document without an id passes the stages that decide by text; of
rows that share id and text one stays after near_dedup. Ties go to the
least id. Texts are read whole, whatever their length. Columns beyond those
of ``documents`` are ignored. Empty tables give empty tables; without
labels or benchmark the rules judge by their fixed limits and nothing is
contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontam, minhash, mixing, quality, sharding
from cohortloom.llm.common import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs.select(*COLUMNS), labels)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8).

    The document with the least id stays. Rows that share that id and are
    near copies of each other stay once; a row without an id stays."""
    read = docs.select(*COLUMNS)
    return minhash.drop_copies(read, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontam.keep_clean(docs.select(*COLUMNS), bench)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until their sources meet the targets."""
    return mixing.repeated(docs.select(*COLUMNS))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return sharding.shard(docs.select("doc_id", "text"), 16)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The scores and draws rest on hashes that SQL engines do not share; the
#: tests compare run() with its stages and with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
