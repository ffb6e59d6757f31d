"""Columnar copies of the token table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotonoha.functions.words import is_variant
from kotonoha.operators.derived import fit_schema
from kotonoha.operators.tokenize import tokenize


def write_tokens(tokens: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """ZSTD Parquet, range-partitioned and sorted by (doc_id, token_id).

    The sort gives each row group a narrow doc_id range, which is what range
    reads prune by; a long document may span files. token_info is stored as
    JSON text, also where it is a VARIANT.
    """
    keys = ["doc_id", "token_id"]
    _write(_stored(tokens).repartitionByRange(*keys).sortWithinPartitions(*keys), path, mode)


def write_document_tokens(
    docs: DataFrame, path: str, *, mode: str = "overwrite", id_col: str = "doc_id", text_col: str = "text", **options
) -> None:
    """The file layout of ``write_tokens`` for documents not tokenized yet.

    The texts are range-partitioned and sorted, and tokenized where they then are: their
    tokens, many times as large, are neither shuffled nor sorted. Documents of one
    doc_id stand one after the other. ``options`` are those of ``tokenize``.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # The text deals out documents that share a doc_id or have none.
    placed = named.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    _write(_stored(tokenize(placed, placed=True, **options)), path, mode)


def _stored(tokens: DataFrame) -> DataFrame:
    if "token_info" in tokens.columns and is_variant(tokens, "token_info"):
        tokens = tokens.withColumn("token_info", F.to_json("token_info"))
    return fit_schema(tokens)


def _write(rows: DataFrame, path: str, mode: str) -> None:
    rows.write.mode(mode).option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(
        "doc_id long, token_id int, word string, pos string, token_info string"
    ).parquet(path)
