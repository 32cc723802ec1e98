"""A corpus pipeline: each stage reads what the stage before it wrote and keeps, changes or
drops whole documents.

Language ID, one document of each group of near copies, benchmark decontamination, secrets,
BPE. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devtide.llm import bpe, decontamination, language_id, ngram_join, secret_scan, shared


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled rows of the input; documents of no known language go."""
    return language_id.keep_known(docs, language_id.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return ngram_join.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with leaked benchmark items go."""
    return decontamination.without_leaks(docs, shared.read(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; all documents stay."""
    return secret_scan.redact(docs, secret_scan.public_ranks())


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether they decode to it."""
    vocabulary = bpe.public_vocabulary()
    coded = bpe.round_trip(docs, vocabulary)
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_join", near_copies),
    ("decontamination", benchmark),
    ("secret_scan", redaction),
    ("bpe", tokens),
]

#: SQL cannot learn languages or merge bytes; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name)
    return docs
