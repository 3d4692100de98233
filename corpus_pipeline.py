"""Stages that turn ``documents`` into a training order. See ``STAGES``.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``docs``; the last one returns the mix. Empty tables, nulls, repeated rows and further columns are
treated as the operators' docstrings say; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyfold.llm import decontaminate, jaccard_join, language, line_dedup, mixing  # noqa: E402
from tallyfold.workspace import run_dir  # noqa: E402


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; the model is learned from the labelled, not held-out documents of the input."""
    return language.accepted(docs, language.train_fold(docs))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in the last of them only."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; documents that are mostly such passages go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix is written in training order; words taken from every document and its places in the curriculum come from it."""
    return mixing.documents_of_mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

# A learned language model has no SQL form; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
