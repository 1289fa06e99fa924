"""From raw documents to shuffled training shards.

Each stage is written as Parquet into the shared folder before the next begins,
so a lost executor costs no finished stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontam, langid, mixing, near_copies, sharding
from millrace.llm.staging import staged

SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is not recognised."""
    return langid.without_rejected(docs, langid.fit(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return near_copies.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by the sources' targets; a document may come up to 3 times."""
    return mixing.mixed_rows(docs, SHARDS).select(*[f"`{c}`" for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each row's shard and its slot there."""
    return sharding.shuffled(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shard),
]

# A trained model and 64-bit hashes have no DuckDB form; tests compare run() with
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
