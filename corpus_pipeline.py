"""A corpus from documents to packed sequences, stage after stage. Each stage is written as Parquet and read by the next one.

All stages take null and empty texts, rows without an id, repeated rows, columns of any name beside ``doc_id`` and ``text``, and
empty tables; what each makes of them is said there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timberline.llm import decontamination, neardup, packing, pii, toxicity
from timberline.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go. Null and empty texts and, without labels, all documents stay."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates stays.

    Of rows that repeat with id and text one stays, and of equal texts without an id. Null and empty texts are like no other.
    """
    return neardup.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go. Null and empty texts stay, and items without words or id say nothing."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by the names of their kinds; all documents stay, and null texts stay null."""
    return pii.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 4096 tokens. A null or empty text is the end id alone."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("packing", pack),
]

# The rows come from a learned model, a tokeniser and random draws, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
