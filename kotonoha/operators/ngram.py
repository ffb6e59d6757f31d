"""N-gram generation and counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kotonoha.operators.frequency import _ranked
from kotonoha.operators.pruning import prune_rare
from kotonoha.operators.reader import word_blocks
from kotonoha.plans.layout import TOKENS_PER_BLOCK
from kotonoha.schemas import require_columns


# Longest n-gram written as a plain concatenation of its words.
DIRECT_WORDS = 8


def array_ngrams(words: Column, n: int) -> Column:
    """All contiguous n-grams of a word array, joined by one space."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return words
    # size - n may be negative or NULL; both give an empty list.
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(
        F.array().cast("array<int>")
    )

    def joined(i: Column) -> Column:
        if n > DIRECT_WORDS:
            return F.concat_ws(" ", F.slice(words, i, n))
        # Picking the words one by one copies nothing.
        parts = [F.get(words, i + (k - 1)) for k in range(n)]
        return F.concat(*[x for p in parts for x in (F.lit(" "), p)][1:])

    return F.transform(starts, joined)


def ngram_rows(
    tokens: DataFrame,
    n: int = 2,
    *,
    id_col: str = "doc_id",
    order_col: str = "token_id",
    word_col: str = "word",
    block_size: int = TOKENS_PER_BLOCK,
) -> DataFrame:
    """``[doc_id, ngram]`` from the long token table, without counting.

    NULL words are dropped first, so their neighbours become adjacent. Tokens
    are grouped by (document, block of positions): a document of any length is
    spread over many bounded groups. N-grams across a block border are built
    from the last and first n - 1 words of neighbouring blocks, which travel as
    one small row per block.
    """
    require_columns(tokens, [id_col, order_col, word_col], "ngram_rows")
    if n == 1:
        return tokens.where(F.col(word_col).isNotNull()).select(
            id_col, F.col(word_col).alias("ngram")
        )
    blocks = word_blocks(
        tokens, id_col=id_col, order_col=order_col, word_col=word_col, block_size=block_size
    )
    inside = blocks.select(id_col, F.explode(array_ngrams(F.col("_words"), n)).alias("ngram"))

    size = F.size("_words")
    edge = blocks.select(
        id_col,
        "_block",
        F.slice("_words", 1, n - 1).alias("_head"),
        F.slice("_words", F.greatest(size - n + 2, F.lit(1)), F.lit(n - 1)).alias("_tail"),
    )
    # Every block has a word, so the next n - 1 blocks hold the n - 1 words needed.
    following = Window.partitionBy(id_col).orderBy("_block").rowsBetween(1, n - 1)
    halo = F.slice(F.flatten(F.collect_list("_head").over(following)), 1, n - 1)
    border = edge.select(id_col, "_tail", halo.alias("_halo")).where(F.size("_halo") > 0)
    crossing = border.select(
        id_col, F.explode(array_ngrams(F.concat("_tail", "_halo"), n)).alias("ngram")
    )
    return inside.unionByName(crossing)


def _counted(
    grams: DataFrame, min_count: int, top_k: int | None, ordered: bool, buckets: int | None = None
) -> DataFrame:
    if buckets:
        grams = prune_rare(grams, "ngram", min_count, buckets)
    counts = grams.groupBy("ngram").agg(F.count(F.lit(1)).alias("count"))
    if min_count > 1:
        counts = counts.where(F.col("count") >= min_count)
    return _ranked(counts, "ngram", top_k, ordered)


def count_ngrams(
    tokens: DataFrame,
    *,
    n: int = 2,
    min_count: int = 1,
    top_k: int | None = None,
    id_col: str = "doc_id",
    order_col: str = "token_id",
    word_col: str = "word",
    ordered: bool = True,
    block_size: int = TOKENS_PER_BLOCK,
    buckets: int | None = None,
) -> DataFrame:
    """``[ngram, count]`` of a long token table (count desc, ngram asc).

    With ``buckets`` n-grams that cannot reach ``min_count`` are left out before
    the shuffle (see ``pruning``), for one more pass over the tokens.
    """
    grams = ngram_rows(
        tokens, n, id_col=id_col, order_col=order_col, word_col=word_col, block_size=block_size
    )
    return _counted(grams.select("ngram"), min_count, top_k, ordered, buckets)


def ngram_rows_of_lists(
    lists: DataFrame, n: int = 2, *, id_col: str = "doc_id", words_col: str = "words"
) -> DataFrame:
    """``[doc_id, ngram]`` of word arrays; no shuffle at all."""
    require_columns(lists, [id_col, words_col], "ngram_rows_of_lists")
    words = F.filter(F.col(words_col), lambda w: w.isNotNull())
    clean = lists.select(id_col, words.alias("_words"))
    return clean.select(id_col, F.explode(array_ngrams(F.col("_words"), n)).alias("ngram"))


def count_ngrams_of_lists(
    lists: DataFrame,
    *,
    n: int = 2,
    min_count: int = 1,
    top_k: int | None = None,
    words_col: str = "words",
    ordered: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """``[ngram, count]`` of word arrays: the only shuffle is the count itself.

    ``buckets`` as in ``count_ngrams``.
    """
    require_columns(lists, [words_col], "count_ngrams_of_lists")
    words = F.filter(F.col(words_col), lambda w: w.isNotNull())
    clean = lists.select(words.alias("_words"))
    grams = clean.select(F.explode(array_ngrams(F.col("_words"), n)).alias("ngram"))
    return _counted(grams, min_count, top_k, ordered, buckets)
