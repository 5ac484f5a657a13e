"""A training corpus from raw documents, in stages that are each written and read again.

Stages: documents of low quality go; of near-duplicates one stays; secrets are
replaced; sources are mixed to their target weights; the mix is tokenised and
packed.  All but the last return the columns of their input.  Operators treat
nulls, empty tables, repeated rows and extra columns as their modules state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, near_dup, packing, quality_rules, secret_scan
from tidemark.llm.queries_text import byte_bpe
from tidemark.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five words and a similarity of 0.8, the operator's defaults, with half keys of two minhashes."""
    return near_dup.kept_documents(docs, rows=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, byte_bpe())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("source_mix", mixture),
    ("packing", packed),
]

# tokenising and the cost of guessing a secret are beyond SQL; tests hold the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; every stage but the last is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
