"""The corpus pipeline: language, near duplicates, benchmark leaks, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written to the shared folder and read again as the
next stage's documents. All stages but the last return the columns they were given. Documents go for four reasons only:
their language cannot be told, they are near copies (five-word shingles, similarity 0.8 or more) of one with a smaller id,
a benchmark passage stands in them, or the mix gives them no copy. A document that the mix wants more often than once is
repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salescope.llm import decontamination, language, mixing, neardup, sharding
from salescope.sources.scratch import materialise


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence."""
    return language.keep_known(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep_one(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the domains ask for."""
    return mixing.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard of 16 and their slot in it."""
    return sharding.shard(docs, 16)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_domains),
    ("sharding", deal_shards),
]

# Learned models and random draws have no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
