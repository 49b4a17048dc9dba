"""Corpus pipeline: the documents through five stages, each written and read again.

quality       rejects documents that the quality classifier predicts 0
near_dups     keeps one document of each component of the n-gram Jaccard join (five words, 0.8)
decontaminate drops documents with a verified benchmark match
mix           repeats or leaves out documents so that the sources meet their targets
shard         gives each document its shard and slot

Every stage works on all that its predecessor kept.  All but the last return the
columns of ``documents``; columns beyond those are dropped by the first stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontam, jaccard_join, mixing, quality_crf, sharding
from shelfcast.llm.common import DOC_COLS, pick, table
from shelfcast.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; null and blank texts score 0 and go."""
    return quality_crf.classify(pick(docs, *DOC_COLS), table(spark, sf_dir, "labels"), keep=tuple(DOC_COLS)).where(
        "predicted = 1").select(*DOC_COLS)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least row of each component; of repeated rows one."""
    return jaccard_join.keep_one(pick(docs, *DOC_COLS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any verified match with an item of ``benchmark``."""
    return decontam.clean(pick(docs, *DOC_COLS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a copy for each epoch that takes at least
    half of a document's words (only the one on the border of a source's stream is cut)."""
    return mixing.repeat_documents(pick(docs, *DOC_COLS))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard, slot and grown_shard; copies share the shard of their doc_id."""
    keyed = pick(docs, *DOC_COLS).withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return sharding.shard_records(keyed, "doc_id", ["text_crc32"])


STAGES = [("quality", quality), ("near_dups", near_dups), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

ORACLE_SQL = None          # fitted and hashed stages; tests/llm compares the run with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
