"""Inputs shared by the registered queries, in Spark and in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotonoha.operators.tokenize import tokenize
from kotonoha.plans.layout import shared_scratch


def registry():
    """(queries, SQL, decorator) of a module of checks."""
    queries, oracles = {}, {}

    def check(name: str, sql: str | None = None):
        def keep(query):
            queries[name] = query
            if sql:
                oracles[name] = sql
            return query

        return keep

    return queries, oracles, check


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def doc_tokens(spark: SparkSession, folder: str, **options) -> DataFrame:
    return tokenize(documents(spark, folder), **options)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder on the storage the session shares."""
    return f"{shared_scratch(spark)}/{name}-{uuid.uuid4().hex}"


# Unicode whitespace as an RE2 class body.
SPACES = (
    r"\t\n\x0b\x0c\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The fixture texts hold no Han or kana, so script runs reduce to letter runs.
PATTERN = r"[\p{L}\p{M}]+|\p{Nd}+(?:\.\p{Nd}+)?|[^\p{L}\p{M}\p{Nd}" + SPACES + "]"


def sql_tokens(source: str = "documents", id_col: str = "doc_id") -> str:
    """SELECT of the long token table of a text table."""
    return f"""
      SELECT {id_col}, CAST(i AS INTEGER) AS token_id, w AS word,
             CASE WHEN regexp_matches(w, '^[\\p{{L}}\\p{{M}}]') THEN 'word'
                  WHEN regexp_matches(w, '^\\p{{Nd}}') THEN 'number'
                  ELSE 'symbol' END AS pos
      FROM (SELECT {id_col}, unnest(ws) AS w, unnest(range(0, len(ws))) AS i
            FROM (SELECT {id_col}, regexp_extract_all(text, '{PATTERN}') AS ws FROM {source}))"""


def with_tokens(body: str, source: str = "documents", id_col: str = "doc_id") -> str:
    return f"WITH tok AS ({sql_tokens(source, id_col)}) {body}"


# Part-of-speech names of the derived variants, given to script tokens so that
# every branch of the variants is taken.
def variant_input(spark: SparkSession, folder: str, **options) -> DataFrame:
    tokens = doc_tokens(spark, folder, **options)
    word = F.col("word")
    pos = (
        F.when(F.col("pos") == "symbol", F.when(word == "-", F.lit("感動詞")).otherwise(F.lit("補助記号")))
        .when(F.col("pos") == "number", F.lit("名詞"))
        .when(word.rlike(r"^\p{Lu}"), F.lit("動詞"))
        .otherwise(F.lit("名詞"))
    )
    return tokens.select("doc_id", "token_id", F.lower("word").alias("word"), pos.alias("pos"), "token_info")


SQL_VARIANT_INPUT = f"""
  SELECT doc_id, token_id, lower(word) AS word, word AS surface,
         CASE WHEN pos = 'symbol' THEN CASE WHEN word = '-' THEN '感動詞' ELSE '補助記号' END
              WHEN pos = 'number' THEN '名詞'
              WHEN regexp_matches(word, '^\\p{{Lu}}') THEN '動詞' ELSE '名詞' END AS pos
  FROM ({sql_tokens()})"""
