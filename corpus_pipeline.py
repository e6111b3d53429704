"""Cleaning of a training corpus: quality, near duplicates, passages, benchmarks, tokens.

``STAGES`` lists the stages in order; every one takes ``(spark, docs, sf_dir)`` and works on
all documents that its predecessor kept. All but the last return the columns they got.
``run`` writes each stage's result to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, near_dup, quality, queries, scratch, substring


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.scored(docs, quality.fit(docs, labels), "__score")
    return found.where(F.col("__score") >= quality.THRESHOLD).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_dup.distinct_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of passages are cut out of the texts; every document stays."""
    return substring.without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated with benchmark items go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, items)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with digests of ids and decoded text."""
    return queries.encoded_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("BPE encoding", token_ids),
]

# Trained scores, sketches and content-defined cuts have no SQL; tests/llm compares the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
