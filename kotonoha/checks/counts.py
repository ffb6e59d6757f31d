"""Frequencies, matrices, vocabulary and n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from kotonoha.checks.common import doc_tokens, documents, registry, sql_tokens, table, with_tokens
from kotonoha.operators.filters import filter_tokens
from kotonoha.operators.frequency import (
    cloud_weights,
    column_sums,
    corpus_size,
    document_word_counts,
    pos_distribution,
    term_frequency,
    tf_idf,
    vocabulary,
    vocabulary_index,
)
from kotonoha.operators.ngram import (
    count_ngrams,
    count_ngrams_of_lists,
    ngram_rows,
    ngram_rows_of_lists,
)
from kotonoha.operators.tokenize import tokenize, tokenize_words

QUERIES, ORACLES, check = registry()


# Whole-vocabulary results are compared as sets, so the queries skip the global
# sort; ranked results keep it.


@check("tf", with_tokens("SELECT word, count(*) AS count FROM tok GROUP BY word"))
def _(spark, folder):
    return term_frequency(doc_tokens(spark, folder), ordered=False)


@check("tf_pos", with_tokens("SELECT word, count(*) AS count FROM tok WHERE pos = 'number' GROUP BY word"))
def _(spark, folder):
    return term_frequency(doc_tokens(spark, folder), pos="number")


@check("pos_dist", with_tokens("SELECT pos, count(*) AS count FROM tok GROUP BY pos"))
def _(spark, folder):
    return pos_distribution(doc_tokens(spark, folder))


_MATRIX = "SELECT doc_id, word, count(*) AS count FROM tok GROUP BY doc_id, word"


@check("bow_matrix", with_tokens(_MATRIX))
def _(spark, folder):
    return document_word_counts(doc_tokens(spark, folder))


@check("bow_sums", with_tokens("SELECT word, count(*) AS count FROM tok GROUP BY word"))
def _(spark, folder):
    """Column sums of the matrix; the same rows as ``tf``."""
    return column_sums(document_word_counts(doc_tokens(spark, folder)))


@check("vocab", with_tokens("SELECT word, count(*) AS count FROM tok GROUP BY word HAVING count(*) >= 5"))
def _(spark, folder):
    return vocabulary(doc_tokens(spark, folder), min_count=5)


@check(
    "vocab_index",
    with_tokens(
        """SELECT word, count(*) AS count, row_number() OVER (ORDER BY word) - 1 AS word_id
           FROM tok GROUP BY word HAVING count(*) >= 2"""
    ),
)
def _(spark, folder):
    return vocabulary_index(doc_tokens(spark, folder), min_count=2)


@check(
    "corpus_size",
    with_tokens(
        """SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_tokens, count(DISTINCT word) AS n_words
           FROM tok"""
    ),
)
def _(spark, folder):
    return corpus_size(doc_tokens(spark, folder))


@check(
    "cloud_weights",
    with_tokens(
        """SELECT word, count, round(count / max(count) OVER (), 6) AS weight FROM (
             SELECT word, count(*) AS count FROM tok WHERE pos = 'word' AND word NOT IN ('the', 'of')
             GROUP BY word ORDER BY count DESC, word LIMIT 200)"""
    ),
)
def _(spark, folder):
    words = filter_tokens(doc_tokens(spark, folder), pos_keep="word")
    top = cloud_weights(words, stopwords=["the", "of"], top=200, strict=False)
    return top.withColumn("weight", F.round("weight", 6))


@check(
    "tfidf",
    with_tokens(
        f""", m AS ({_MATRIX}), df AS (SELECT word, count(*) AS df FROM m GROUP BY word),
             n AS (SELECT count(DISTINCT doc_id) AS n FROM m)
        SELECT doc_id, word, count, round(count * (ln((1 + n) / (1 + df)) + 1), 6) AS tfidf
        FROM m JOIN df USING (word), n"""
    ),
)
def _(spark, folder):
    weights = tf_idf(document_word_counts(doc_tokens(spark, folder)))
    return weights.withColumn("tfidf", F.round("tfidf", 6))


# -- n-grams ------------------------------------------------------------------


def sql_ngrams(source: str, n: int, id_col: str = "doc_id", order_col: str = "token_id") -> str:
    window = f"OVER (PARTITION BY {id_col} ORDER BY {order_col})"
    parts = ["word"] + [f"lead(word, {i}) {window}" for i in range(1, n)]
    names = ", ".join(f"{p} AS w{i}" for i, p in enumerate(parts))
    joined = " || ' ' || ".join(f"w{i}" for i in range(n))
    return f"""SELECT {id_col}, {joined} AS ngram FROM (SELECT {id_col}, {names} FROM {source})
               WHERE w{n - 1} IS NOT NULL"""


def sql_counted(source: str, n: int, tail: str = "", **cols: str) -> str:
    return f"SELECT ngram, count(*) AS count FROM ({sql_ngrams(source, n, **cols)}) GROUP BY ngram {tail}"


@check("ngram2", with_tokens(sql_counted("tok", 2)))
def _(spark, folder):
    """All bigrams straight from the texts: one shuffle."""
    return count_ngrams_of_lists(tokenize_words(documents(spark, folder)), n=2, ordered=False)


@check("ngram3", with_tokens(sql_counted("tok", 3, "HAVING count(*) >= 2")))
def _(spark, folder):
    lists = tokenize_words(documents(spark, folder))
    return count_ngrams_of_lists(lists, n=3, min_count=2, ordered=False)


@check("ngram3_pruned", with_tokens(sql_counted("tok", 3, "HAVING count(*) >= 2")))
def _(spark, folder):
    """The same; n-grams that cannot occur twice are left out before the shuffle."""
    lists = tokenize_words(documents(spark, folder))
    return count_ngrams_of_lists(lists, n=3, min_count=2, ordered=False, buckets=1 << 24)


@check("vocabulary_pruned", with_tokens("SELECT word, count(*) AS count FROM tok GROUP BY word HAVING count(*) >= 5"))
def _(spark, folder):
    return vocabulary(doc_tokens(spark, folder, info_col=None), min_count=5, buckets=1 << 22)


@check("ngram_topk", with_tokens(sql_counted("tok", 2, "ORDER BY count DESC, ngram LIMIT 20")))
def _(spark, folder):
    return count_ngrams_of_lists(tokenize_words(documents(spark, folder)), n=2, top_k=20)


@check("ngram_unigram", with_tokens("SELECT word AS ngram, count(*) AS count FROM tok GROUP BY word"))
def _(spark, folder):
    """n = 1 gives the term frequencies."""
    return count_ngrams(doc_tokens(spark, folder), n=1, ordered=False)


@check(
    "ngram_filtered",
    with_tokens(
        ", kept AS (SELECT * FROM tok WHERE pos = 'word') " + sql_counted("kept", 2, "HAVING count(*) >= 2")
    ),
)
def _(spark, folder):
    """From the long table after a filter: removed tokens close the gap."""
    kept = filter_tokens(doc_tokens(spark, folder, info_col=None), pos_keep="word")
    return count_ngrams(kept, n=2, min_count=2, ordered=False)


@check(
    "ngram_null_words",
    with_tokens(
        """, kept AS (SELECT * FROM tok WHERE pos <> 'symbol') """ + sql_counted("kept", 3)
    ),
)
def _(spark, folder):
    """NULL words are dropped before n-grams are built."""
    word = F.when(F.col("pos") != "symbol", F.col("word"))
    tokens = doc_tokens(spark, folder, info_col=None).withColumn("word", word)
    return count_ngrams(tokens, n=3, ordered=False)


@check(
    "ngram_conversations",
    f"""WITH c AS (SELECT conv_id * 1000 + turn AS k, conv_id, turn, text FROM conversations),
             tok AS ({sql_tokens("c", "k")}),
             t AS (SELECT k // 1000 AS conv_id, (k % 1000) * 1000000 + token_id AS place, word FROM tok)
        {sql_counted("t", 2, id_col="conv_id", order_col="place")}""",
)
def _(spark, folder):
    """Bigrams over whole conversations: positions run across the turns."""
    turns = table(spark, folder, "conversations").withColumn("k", F.struct("conv_id", "turn"))
    tokens = tokenize(turns, id_col="k", info_col=None)
    ordered = tokens.select(
        "k.conv_id", (F.shiftleft(F.col("k.turn"), 32) + F.col("token_id")).alias("at"), "word"
    )
    return count_ngrams(ordered, n=2, id_col="conv_id", order_col="at", ordered=False)


_PER_DOC = "SELECT doc_id, count(*) AS n, min(ngram) AS first, max(ngram) AS last FROM ({}) GROUP BY doc_id"


@check("bigram_rows", with_tokens(_PER_DOC.format(sql_ngrams("tok", 2))))
def _(spark, folder):
    """Bigrams per document without counting, from word arrays."""
    rows = ngram_rows_of_lists(tokenize_words(documents(spark, folder)), 2)
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ngram").alias("first"), F.max("ngram").alias("last")
    )


@check("fourgram_rows", with_tokens(_PER_DOC.format(sql_ngrams("tok", 4))))
def _(spark, folder):
    """The same from the long table, over block borders."""
    rows = ngram_rows(doc_tokens(spark, folder, info_col=None), 4)
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ngram").alias("first"), F.max("ngram").alias("last")
    )
