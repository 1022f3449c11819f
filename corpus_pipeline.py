"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before it kept.  All but the last return the columns of
``documents``; the last returns the mix: what each remaining document gives.
``run`` writes every stage's rows as Parquet into the shared folder and reads
them again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelfold.llm import decontam, exact_dedup, mixing, ngram_join, pu_quality
from labelfold.session import read_table, scratch_path, temporary_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the classifier rejects go."""
    return pu_quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of equal texts the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: one document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: what the mix takes of each remaining document."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("mix", mix),
]

#: A trained classifier and pseudorandom draws are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        kept = []
        # a stage's own tables are not needed once its rows are written
        with temporary_scratch(spark, kept):
            path = scratch_path(spark, f"pipeline-{name}")
            kept.append(path)
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
