"""From raw documents to packed sequences: quality, exact and near duplicates, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinloom.llm import classifier, exact, mixing, near, packing
from twinloom.llm.rows import written


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labelled ones given, takes for quality 1."""
    weights = classifier.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "true")
    score = "score"
    while score in docs.columns:
        score += "_"
    return classifier.score(docs, weights, score).where(f"`{score}` >= 0.5").select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text up to white space, that with the smallest doc_id."""
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at Jaccard 0.8 or more, that with the smallest doc_id."""
    return near.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice."""
    return mixing.mixed_corpus(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_low_quality),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learned scores, sketches and tokens have no SQL form; tests compare each stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
