"""Structured Streaming into a store, each stream run to the end of its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotonoha.checks.common import documents, registry, scratch, sql_tokens, table
from kotonoha.operators.reader import tokens_to_text
from kotonoha.plans.store import CorpusStore
from kotonoha.streaming.streams import stream_content, stream_files, stream_tokens

QUERIES, ORACLES, check = registry()


def finish(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@check(
    "stream_ingest",
    """SELECT page_id, regexp_replace(html, '\\r\\n?', chr(10), 'g') || chr(10) AS text,
              CAST(length(regexp_replace(html, '\\r\\n?', chr(10), 'g')) + 1 AS BIGINT) AS char_count FROM pages""",
)
def _(spark, folder):
    """Every page as a file of its own, fetched by a file stream."""
    files = scratch(spark, "pages")
    table(spark, folder, "pages").select("page_id", "html").write.partitionBy("page_id").text(files)
    store = CorpusStore(spark, scratch(spark, "stream-files"))
    finish(stream_files(store, files, checkpoint=scratch(spark, "stream")))
    page = F.regexp_extract("rel_path", "page_id=([0-9]+)", 1).cast("long")
    return (
        store.texts()
        .join(store.documents(), "doc_id")
        .select(page.alias("page_id"), "text", F.col("char_count").cast("long").alias("char_count"))
    )


@check("stream_upsert", "SELECT CAST(doc_id AS VARCHAR) AS original_id, text FROM documents")
def _(spark, folder):
    store = CorpusStore(spark, scratch(spark, "stream-content"))
    _stream_documents(spark, folder, store)
    return store.texts().join(store.documents(), "doc_id").select(
        F.col("rel_path").alias("original_id"), "text"
    )


def _stream_documents(spark, folder, store):
    schema = documents(spark, folder).schema
    source = spark.readStream.schema(schema).parquet(f"{folder}/documents*.parquet")
    finish(
        stream_content(
            store, source, "doc_id", "text", order_col="doc_id", checkpoint=scratch(spark, "stream")
        )
    )


@check(
    "stream_tokenize",
    f"""WITH tok AS ({sql_tokens()})
    SELECT CAST(doc_id AS VARCHAR) AS original_id, string_agg(word, ' ' ORDER BY token_id) AS text
    FROM tok GROUP BY doc_id""",
)
def _(spark, folder):
    """Content stream, then a token stream over what it stored."""
    store = CorpusStore(spark, scratch(spark, "stream-tokens"))
    _stream_documents(spark, folder, store)
    finish(stream_tokens(store, checkpoint=scratch(spark, "stream")))
    names = store.documents().select("doc_id", F.col("rel_path").alias("original_id"))
    return tokens_to_text(store.tokens()).join(names, "doc_id").select("original_id", "text")
