"""The corpus pipeline: quality rules, SimHash near-dedup, benchmark decontamination, mixing to
target weights, sharding. Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame;
``run`` writes each stage's rows as Parquet in the shared checkpoint folder and reads them back
as the next stage's ``docs``. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from threatlake.llm import decontaminate, mixing, quality, sharding, simhash
from threatlake.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return simhash.one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture draws them (each at least once)."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.shard(docs)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources", source_mixing), ("sharding", shards)]

# Fingerprints (XXH64), permutations and CRC-32 have no SQL form in DuckDB; tests/llm compares
# the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
