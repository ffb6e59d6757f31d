"""Edges, merged edges and degrees from ranked n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotonoha.checks.common import documents, registry, with_tokens
from kotonoha.checks.counts import sql_counted
from kotonoha.operators.graph import cooccurrence_graph, edges, merge_edges
from kotonoha.operators.ngram import count_ngrams_of_lists
from kotonoha.operators.tokenize import tokenize_words

QUERIES, ORACLES, check = registry()


HEAD = 300


def _ranked(n: int) -> str:
    return f"""ranked AS (SELECT ngram, count, CAST(row_number() OVER (ORDER BY count DESC, ngram) AS INTEGER) AS rank
                FROM ({sql_counted("tok", n)}) ORDER BY count DESC, ngram LIMIT {HEAD}),
      e AS (SELECT rank, split_part(ngram, ' ', 1) AS source,
                   substr(ngram, length(split_part(ngram, ' ', 1)) + 2) AS target, count FROM ranked)"""


MERGED = """m AS (SELECT least(source, target) AS source, greatest(source, target) AS target,
                         {agg} AS count FROM e GROUP BY ALL)"""
LAST = MERGED.format(agg="arg_max(count, rank)")
SUM = MERGED.format(agg="CAST(sum(count) AS BIGINT)")


def _grams(spark, folder, n=2):
    return count_ngrams_of_lists(tokenize_words(documents(spark, folder)), n=n, top_k=HEAD)


@check("edges", with_tokens(f", {_ranked(2)} SELECT rank, source, target, count FROM e"))
def _(spark, folder):
    return edges(_grams(spark, folder), head=HEAD, strict=False)


@check("edges_trigram", with_tokens(f", {_ranked(3)} SELECT rank, source, target, count FROM e"))
def _(spark, folder):
    """The target of a trigram is its last two words."""
    return edges(_grams(spark, folder, 3), head=HEAD, strict=False)


@check(
    "edges_merged",
    with_tokens(
        f", {_ranked(2)}, {LAST} SELECT source, target, count, round(count / max(count) OVER () * 4 + 1, 6) AS width FROM m"
    ),
)
def _(spark, folder):
    merged, _ = cooccurrence_graph(_grams(spark, folder), head=HEAD, strict=False)
    return merged.withColumn("width", F.round("width", 6))


@check("edges_summed", with_tokens(f", {_ranked(2)}, {SUM} SELECT source, target, count FROM m"))
def _(spark, folder):
    return merge_edges(edges(_grams(spark, folder), head=HEAD, strict=False), merge="sum")


@check(
    "degree",
    with_tokens(
        f""", {_ranked(2)}, {LAST}
        SELECT word, count(*) AS degree
        FROM (SELECT source AS word FROM m UNION ALL SELECT target FROM m) GROUP BY word"""
    ),
)
def _(spark, folder):
    return cooccurrence_graph(_grams(spark, folder), head=HEAD, strict=False)[1]
