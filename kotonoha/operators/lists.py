"""The token operators on rows of ``[doc_id, tokens]``: nothing is exploded or shuffled.

Texts and stored works have one row per document, so filters, word forms,
variants and joined texts are expressions on the token array. The block forms in
``filters``, ``reader`` and ``variants`` are for genuinely long tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotonoha.functions import text as text_fn
from kotonoha.functions.words import as_name_list, form_from_info
from kotonoha.operators.filters import LITERAL_STOPWORDS, literal_stopwords, split_stopwords, stopword_table
from kotonoha.operators.variants import FILTERED_DROP, HYBRID_DROP, HYBRID_KEEP_FORM, POS_BLANK
from kotonoha.schemas import TOKEN_LIST, require_columns

TokenRule = Callable[[Column], Column]


def keep_tokens(lists: DataFrame, rule: TokenRule) -> DataFrame:
    """Tokens for which the rule is true; positions are never renumbered."""
    require_columns(lists, ["tokens"], "keep_tokens")
    return lists.withColumn("tokens", F.filter("tokens", rule))


def change_words(lists: DataFrame, rule: TokenRule) -> DataFrame:
    """Every word replaced by the rule's value; the other fields stay."""
    require_columns(lists, ["tokens"], "change_words")

    def changed(token: Column) -> Column:
        return F.struct(
            token["token_id"].alias("token_id"),
            rule(token).alias("word"),
            token["pos"].alias("pos"),
            token["token_info"].alias("token_info"),
        )

    return lists.withColumn("tokens", F.transform("tokens", changed).cast(TOKEN_LIST))


def filter_lists(lists: DataFrame, *, pos_keep=None, pos_exclude=None, stopwords=None) -> DataFrame:
    """Keep, then exclude, then drop stopwords, as ``filter_tokens`` does.

    A NULL pos fails ``pos_keep`` but passes ``pos_exclude``; a NULL word is
    never a stopword. Few literal stopwords are part of the expression; tables,
    and more than ``LITERAL_STOPWORDS``, meet the different words of every
    document in a join, and the lists are filtered by what was found there.
    """
    keep, drop = as_name_list(pos_keep), as_name_list(pos_exclude)
    tables, values = split_stopwords(stopwords)
    banned = sorted(literal_stopwords(values))
    if tables or len(banned) > LITERAL_STOPWORDS:
        lists = _without_table(lists, stopword_table(lists.sparkSession, stopwords))
        banned = []

    def among(value: Column, names: list[str]) -> Column:
        return F.coalesce(value.isin(names), F.lit(False))

    def rule(token: Column) -> Column:
        kept = among(token["pos"], keep) if keep else F.lit(True)
        if drop:
            kept = kept & ~among(token["pos"], drop)
        return kept & ~among(token["word"], banned) if banned else kept

    return keep_tokens(lists, rule) if keep or drop or banned else lists


def _without_table(lists: DataFrame, banned: DataFrame) -> DataFrame:
    """Lists without the words of a ``[word]`` table, by the different words of each document."""
    words = lists.select("doc_id", F.explode(F.array_distinct(F.col("tokens")["word"])).alias("word"))
    found = words.join(banned, "word", "left_semi").groupBy(F.col("doc_id").alias("_doc"))
    found = found.agg(F.collect_set("word").alias("_found"))
    joined = lists.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    kept = F.filter(
        "tokens", lambda t: ~F.coalesce(F.array_contains(F.col("_found"), t["word"]), F.lit(False))
    )
    return joined.withColumn("tokens", kept).select(*lists.columns)


def select_form_in_lists(lists: DataFrame, word_form: str) -> DataFrame:
    """Every word in another form kept in its token_info."""
    return change_words(lists, lambda t: form_from_info(t["token_info"], t["word"], word_form))


def _surface(token: Column) -> Column:
    return form_from_info(token["token_info"], token["word"], "surface")


def filtered_lists(lists: DataFrame) -> DataFrame:
    masked = change_words(
        filter_lists(lists, pos_exclude=FILTERED_DROP), lambda t: text_fn.mask_numbers(t["word"])
    )
    return keep_tokens(masked, lambda t: ~text_fn.is_noise(t["word"]))


def surface_lists(lists: DataFrame) -> DataFrame:
    return filter_lists(change_words(lists, _surface), pos_exclude=POS_BLANK)


def hybrid_lists(lists: DataFrame) -> DataFrame:
    def word(token: Column) -> Column:
        content = F.coalesce(token["pos"].isin(*HYBRID_KEEP_FORM), F.lit(False))
        return text_fn.mask_numbers(F.when(content, token["word"]).otherwise(_surface(token)))

    return change_words(filter_lists(lists, pos_exclude=HYBRID_DROP), word)


LIST_VARIANTS = {"filtered": filtered_lists, "surface": surface_lists, "hybrid": hybrid_lists}


def words_of_lists(lists: DataFrame, *, ordered: bool = True) -> DataFrame:
    """``[doc_id, words]``: NULL words dropped, documents without a word left out.

    ``ordered`` says that the lists are in position order, as tokenizers and
    stored works give them.
    """
    tokens = F.col("tokens") if ordered else F.array_sort("tokens")
    words = F.filter(tokens["word"], lambda w: w.isNotNull())
    # A filter on the size would be pushed down and compute the words once more.
    some = F.filter(F.array(words), lambda w: F.size(w) > 0)
    return lists.select("doc_id", F.explode(some).alias("words"))


def text_of_lists(lists: DataFrame, *, sep: str = " ", ordered: bool = True) -> DataFrame:
    """``[doc_id, text]``: the words of every document joined in order."""
    words = words_of_lists(lists, ordered=ordered)
    return words.select("doc_id", F.array_join("words", sep).alias("text"))
