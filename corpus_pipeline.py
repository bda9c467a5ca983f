"""Corpus pipeline: quality rules, near-duplicates, benchmark passages,
mixing, token files.

Each stage gets the documents its predecessor kept, written as Parquet and
reread, and its decision holds for the next one. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netwatch.llm import decontamination, mixing, quality_rules, simhash, token_output
from netwatch.llm.common import materialise, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (operator 6): documents that are rejected go."""
    return quality_rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (operator 4): one document of each group stays."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (operator 7): documents that hold a
    benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights (operator 3): documents come once per
    selected copy."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID output (operator 9) of every document that is left."""
    return token_output.write_and_index(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
    ("token_output", tokens),
]

# No SQL: fingerprints, covariance estimates and a tokenizer are in the way.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
