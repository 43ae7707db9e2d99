"""From raw documents to packed training sequences, stage by stage.

Each stage is one operator of ``tatemono.llm``. Its result is written as
Parquet and read again as the documents of the next stage. All stages but the
last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tatemono.llm import mixing, near_dup, packing, quality_mil, secrets
from tatemono.sources import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_mil.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by its kind."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and places."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
