"""Corpus pipeline: from raw documents to packed training sequences.

Every stage reads all rows its predecessor kept. The filtering stages return the
columns of documents unchanged but for the text, the last one returns the pieces
of the packed sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kotonoha.llm import decontaminate, langid, lines, packing, simhash
from kotonoha.llm.common import fold, table
from kotonoha.plans.layout import remove_folder, shared_scratch
from kotonoha.session import ship_package

# A text is rejected when no language claims it, not even weakly.
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those that no language claims, go."""
    ship_package(spark)
    model = langid.train(docs.where(fold("doc_id", 4) != 2))
    return langid.filter_languages(docs, model, min_score=MIN_LANGUAGE_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten or more documents go from every document."""
    ship_package(spark)
    return lines.drop_repeated_lines(docs).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    ship_package(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontaminate.drop_holders(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

# Learned models and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again.

    A stage's files go once the next stage is written; the last one's stay.
    """
    folder = f"{shared_scratch(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return docs
