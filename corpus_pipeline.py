"""Corpus pipeline: language, exact and near duplicates, benchmark leaks, packing.

Each stage reads what the one before kept and, but for the last, returns rows of ``documents`` with
all their columns. A stage's result is written to the shared folder and reread by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortline.llm import decontam, exact, langid, packing, simhash
from cohortline.llm.registry import table
from cohortline.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is known; texts without a letter go."""
    return langid.keep_identified(docs, langid.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text."""
    return exact.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of SimHash fingerprints that are linked within two bits."""
    return simhash.near_dedup(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a passage of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of what is left."""
    return packing.pack(packing.word_lengths(docs))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", pack),
]

#: SQL has no naive Bayes model, SimHash components or optimal buckets; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
