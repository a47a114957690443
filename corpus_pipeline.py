"""A training corpus from the documents table: five stages, each on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spokewise.llm import decontaminate, exact_dedup, mixing, near_dup, quality
from spokewise.session import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, use=~quality.held_out())
    return quality.score(docs, model, only_good=True)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.drop_near_copies(docs)


def keep_clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in training order."""
    return mixing.digest(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", keep_one_copy),
    ("near_dedup", keep_one_of_near_copies),
    ("decontamination", keep_clean_of_benchmarks),
    ("mixing", mix_sources),
]

# The classifier is trained, which SQL cannot express; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
