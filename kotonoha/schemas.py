"""Explicit schemas of every stored or exchanged table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TOKEN_COLUMNS = ["doc_id", "token_id", "word", "pos", "token_info"]

# One token inside a per-document list.
TOKEN_STRUCT = T.StructType(
    [
        T.StructField("token_id", T.IntegerType()),
        T.StructField("word", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("token_info", T.StringType()),
    ]
)

TOKEN_LIST = T.ArrayType(TOKEN_STRUCT)

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("abs_path", T.StringType()),
        T.StructField("rel_path", T.StringType()),
        T.StructField("source_kind", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("run_id", T.LongType()),
    ]
)

# event: registered | fetched | error. A fetched row carries the text; its
# run_id is the text version.
FETCH_LOG = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("error", T.StringType()),
        T.StructField("char_count", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("run_id", T.LongType()),
    ]
)

# event: registered | done | error | reset. A done row carries the tokens.
TOKENIZE_LOG = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("error", T.StringType()),
        T.StructField("text_version", T.LongType()),
        T.StructField("tokens", TOKEN_LIST),
        T.StructField("run_id", T.LongType()),
    ]
)

# What a fetch log says of a document up to a run, and what a tokenize log does.
FETCH_STATE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("fetched_run", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("attempt_run", T.LongType()),
        T.StructField("attempt_at", T.TimestampType()),
        T.StructField("attempt_error", T.StringType()),
    ]
)
WORK_STATE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("done_run", T.LongType()),
        T.StructField("done_version", T.LongType()),
        T.StructField("reset_run", T.LongType()),
        T.StructField("tried_run", T.LongType()),
        T.StructField("shown_run", T.LongType()),
        T.StructField("shown_at", T.TimestampType()),
        T.StructField("shown_error", T.StringType()),
        T.StructField("shown_version", T.LongType()),
    ]
)


def require_columns(df: DataFrame, columns: list[str], where: str) -> None:
    """KeyError naming the missing columns, raised before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{where}: missing column(s) {missing}; present: {df.columns}")
