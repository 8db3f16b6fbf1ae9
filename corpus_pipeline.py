"""A corpus pipeline of five stages: language, quality rules, near duplicates, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sootledger.llm import language, mixing, packing, rules, simhash
from sootledger.llm.shared import documents, written
from sootledger.session import tune


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without letters, long ones of no clear language, and NULL, go."""
    return language.accepted(docs, language.fit(docs))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read like the trusted ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules.kept(docs, rules.fit(docs, labels))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles similar from 0.8, or near fingerprints."""
    return simhash.keep_one(docs, similar=0.8)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; the workers, which all stages share, give the memory of words back."""
    return packing.digest(packing.pack(docs, packing.vocabulary(), remember=False))


STAGES = [
    ("language", recognised),
    ("rules", of_quality),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

# Hashed n-gram models, kernels and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written before the next one reads them."""
    tune(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
