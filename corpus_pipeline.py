"""A corpus from raw documents: five stages, each a Parquet table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.llm import decontaminate, jaccard_join, piece_spans, quality, secrets
from fleetpulse.llm.catalog import table, tokenizer
from fleetpulse.sinks.tables import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def safe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With every secret masked."""
    return secrets.without_secrets(docs, tokenizer("byte_bpe_50k.tiktoken"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document and the text they decode to: doc_id, ids, starts, ends, decoded."""
    return piece_spans.encode_spans(docs, tokenizer("piece_bpe_32k.model"), decoded=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", clean),
    ("secrets", safe),
    ("pieces", encoded),
]

ORACLE_SQL = None  # SQL cannot express a token vocabulary; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; all but the last are written and read again.

    A null or blank text has no words, so the first stage drops it; null ids,
    languages and sources, repeated rows and further columns pass as the stages'
    operators state. An empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
