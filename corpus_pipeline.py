"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is
written as Parquet before the next one reads it. All but the last return the columns of
documents; the last returns the places of the pieces of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm.decontaminate import drop_contaminated
from barlake.llm.line_dedup import drop_repeated_lines
from barlake.llm.near_dup import drop_near_duplicates
from barlake.llm.packing import pack_documents
from barlake.llm.quality import drop_low_quality
from barlake.llm.storage import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return drop_low_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in their first document only; n_chars follows the text."""
    kept = drop_repeated_lines(docs)
    if "n_chars" not in kept.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without enough words in benchmark passages to be contaminated."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# SQL can't express the tokenizer and the branch and bound of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
