"""Counts over the token table: frequencies, document-word matrix, vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kotonoha.operators.filters import filter_tokens
from kotonoha.operators.pruning import prune_rare
from kotonoha.plans.numbering import number_rows
from kotonoha.plans.layout import cut_lineage, fix_wide
from kotonoha.schemas import require_columns


def _ranked(counts: DataFrame, key: str, top_k: int | None, ordered: bool) -> DataFrame:
    by = [F.desc("count"), F.asc(key)]
    if top_k is not None:
        return counts.orderBy(*by).limit(top_k)
    return counts.orderBy(*by) if ordered else counts


def term_frequency(
    tokens: DataFrame,
    *,
    pos: str | None = None,
    word_col: str = "word",
    pos_col: str = "pos",
    top_k: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """``[word, count]`` over the corpus, most frequent first; NULL words not counted.

    ``ordered=False`` skips the global sort when the caller does not need it.
    """
    require_columns(tokens, [word_col, *([pos_col] if pos is not None else [])], "term_frequency")
    source = tokens if pos is None else tokens.where(F.col(pos_col) == pos)
    counts = (
        source.where(F.col(word_col).isNotNull())
        .groupBy(word_col)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _ranked(counts, word_col, top_k, ordered)


def pos_distribution(tokens: DataFrame, *, pos_col: str = "pos", keep_null: bool = True) -> DataFrame:
    """``[pos, count]``, most frequent first; the NULL group is kept by default."""
    require_columns(tokens, [pos_col], "pos_distribution")
    source = tokens if keep_null else tokens.where(F.col(pos_col).isNotNull())
    counts = source.groupBy(pos_col).agg(F.count(F.lit(1)).alias("count"))
    return _ranked(counts, pos_col, None, True)


def document_word_counts(
    tokens: DataFrame, *, id_col: str = "doc_id", word_col: str = "word"
) -> DataFrame:
    """Sparse document x word matrix in coordinate form, ``[doc_id, word, count]``."""
    require_columns(tokens, [id_col, word_col], "document_word_counts")
    return (
        tokens.where(F.col(word_col).isNotNull())
        .groupBy(id_col, word_col)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def column_sums(matrix: DataFrame, *, word_col: str = "word") -> DataFrame:
    """Word totals of the coordinate matrix; equal to ``term_frequency``."""
    return matrix.groupBy(word_col).agg(F.sum("count").alias("count"))


def vocabulary(
    tokens: DataFrame, *, min_count: int = 1, word_col: str = "word", buckets: int | None = None
) -> DataFrame:
    """Words seen at least ``min_count`` times with their counts.

    With ``buckets`` words that cannot reach ``min_count`` are left out before the shuffle.
    """
    if buckets:
        tokens = prune_rare(tokens.select(word_col), word_col, min_count, buckets)
    counts = term_frequency(tokens, word_col=word_col, ordered=False)
    return counts.where(F.col("count") >= min_count) if min_count > 1 else counts


def vocabulary_index(
    tokens: DataFrame, *, min_count: int = 1, word_col: str = "word"
) -> DataFrame:
    """Vocabulary in alphabetical order with 0-based column numbers."""
    words = vocabulary(tokens, min_count=min_count, word_col=word_col)
    return number_rows(words, [word_col], output="word_id")


def corpus_size(tokens: DataFrame, *, id_col: str = "doc_id", word_col: str = "word") -> DataFrame:
    """One row: documents with a word, tokens, distinct words.

    Two plain hash aggregates instead of two distinct counts in one, which
    would expand every token row twice.
    """
    known = tokens.where(F.col(word_col).isNotNull())
    one, none = F.lit(1), F.lit(0).cast("long")
    per_word = known.groupBy(word_col).agg(F.count(one).alias("n"))
    words = per_word.agg(
        none.alias("n_docs"), F.sum("n").alias("n_tokens"), F.count(one).alias("n_words")
    )
    docs = known.groupBy(id_col).agg(F.count(one)).agg(
        F.count(one).alias("n_docs"), none.alias("n_tokens"), none.alias("n_words")
    )
    totals = [F.coalesce(F.sum(c), none).alias(c) for c in ("n_docs", "n_tokens", "n_words")]
    return words.unionByName(docs).agg(*totals)


def cloud_weights(
    tokens: DataFrame,
    *,
    stopwords=None,
    top: int = 200,
    word_col: str = "word",
    strict: bool = True,
) -> DataFrame:
    """Word-cloud data: the top words and their weight, count / largest count.

    The window runs over the ``top`` rows only. With ``strict`` an empty input
    is an error.
    """
    kept = (
        filter_tokens(tokens, stopwords=stopwords, word_col=word_col)
        if stopwords is not None
        else tokens
    )
    ranked = term_frequency(kept, word_col=word_col, top_k=top)
    if strict:
        ranked = cut_lineage(ranked)  # a few rows, counted once
        if ranked.isEmpty():
            raise ValueError("cloud_weights: no words left")
    largest = F.max("count").over(Window.partitionBy())
    return ranked.withColumn("weight", F.col("count") / largest)


def id_range(tokens: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """``[min_id, max_id]``; no row for an empty table."""
    return tokens.agg(F.min(id_col).alias("min_id"), F.max(id_col).alias("max_id")).where(
        F.col("min_id").isNotNull()
    )


def tf_idf(matrix: DataFrame, *, id_col: str = "doc_id", word_col: str = "word") -> DataFrame:
    """``[doc_id, word, count, tfidf]`` with idf = ln((1 + N) / (1 + df)) + 1.

    Document count and document frequencies come from the matrix itself, whose
    rows are already one per (document, word). It is read twice, so it is fixed
    first and whatever makes it, such as tokenizing, runs once. A word found in
    every document is a hot key of the join, which adaptive execution splits.
    """
    matrix = fix_wide(matrix.select(id_col, word_col, "count"))
    # Counting by the count column keeps all three reads of the matrix the same
    # plan, so its shuffle is computed once and reused.
    cells = F.count_if(F.col("count") > 0)
    per_word = matrix.groupBy(word_col).agg(cells.alias("_df"))
    n_docs = matrix.groupBy(id_col).agg(cells.alias("_n")).agg(F.count_if(F.col("_n") > 0))
    idf = per_word.select(
        word_col, (F.log((n_docs.scalar() + 1) / (F.col("_df") + 1)) + 1).alias("_idf")
    )
    # Fixed first, so that both sides are shuffled for the join alone; the large side
    # is not sorted for it.
    return matrix.join(cut_lineage(idf).hint("shuffle_hash"), word_col).select(
        id_col, word_col, "count", (F.col("count") * F.col("_idf")).alias("tfidf")
    )
