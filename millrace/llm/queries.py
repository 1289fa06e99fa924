"""The registered query of each operator, over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    centroids,
    covertree,
    decontam,
    divergence,
    langid,
    licenses,
    mixing,
    pii,
    quality,
    sharding,
    token_counts,
    urls,
)
from millrace.llm.simhash import near_duplicates

# Where the public tokenizers' files lie, and a key for the pseudonyms; a user
# brings their own.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
PII_KEY = os.environ.get("PII_KEY", "not-a-secret")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.languages(docs, langid.fit(docs))


@query("op7_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_sharding")
def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded_documents(table(spark, sf_dir, "documents"))


@query("op3_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


@query("op9_url_filters", urls.SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


@query("op6_license_scans", licenses.SQL)
def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


@query("op10_pii_pseudonyms")
def pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised_documents(table(spark, sf_dir, "documents"), PII_KEY)


@query("op4_token_counts")
def token_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.sentencepiece_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary)


@query("op8_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op13_centroid_clustering", centroids.SQL)
def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


@query("op12_source_divergence_audit", divergence.SQL)
def source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op11_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
