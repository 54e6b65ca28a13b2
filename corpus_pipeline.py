"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that its predecessor kept and returns documents;
``run`` writes every stage's result as Parquet and goes on from the files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopgrain.llm.decontamination import clean_documents
from shopgrain.llm.language_id import UNKNOWN, learn_with_limit, predicted
from shopgrain.llm.mixing import mixed_rows
from shopgrain.llm.sharding import byte_shards
from shopgrain.llm.simhash import one_per_group
from shopgrain.llm.tables import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without any letter go, and those of
    which too little is known to any language that was learned."""
    model, least = learn_with_limit(docs)
    named = predicted(docs.select(F.struct("*").alias("row"), F.col("text").alias("text")), model, least=least)
    return named.where(F.col("language.lang") != UNKNOWN).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash, of three-word shingles at two or
    fewer differing bits: the one with the smallest doc_id."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return clean_documents(docs, items)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    return mixed_rows(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their place in it."""
    return byte_shards(docs, SHARDS, carry=True).select("row.*", "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Fingerprints and edit distances within texts are beyond SQL; tests compare the
# stages with plain versions instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
