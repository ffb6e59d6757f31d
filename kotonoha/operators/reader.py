"""Per-document reads of the token table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotonoha.operators.filters import filter_tokens
from kotonoha.operators.runs import can_run, expanded, packed_runs, token_runs
from kotonoha.plans.layout import TOKENS_PER_BLOCK, block_of
from kotonoha.schemas import TOKEN_LIST, TOKEN_STRUCT, require_columns

RETURN_MODES = ("tokens", "id_tokens")


def _in_order(items: Column, field: str) -> Column:
    return F.sort_array(items)[field]


def _run_items(runs: DataFrame, id_col: str, order_type: str, order_name: str, item_cols: list[str]) -> DataFrame:
    """``[id, _block, _items]``: the sorted items of every (document, block) of ``token_runs``."""
    blocks = runs.groupBy(id_col, "_block").agg(F.collect_list("_run").alias("_runs"))
    items = expanded(F.col("_runs"), order_type, order_name, item_cols)
    return blocks.select(id_col, "_block", F.sort_array(items).alias("_items"))


def word_blocks(
    tokens: DataFrame,
    *,
    id_col: str = "doc_id",
    order_col: str = "token_id",
    word_col: str = "word",
    block_size: int = TOKENS_PER_BLOCK,
    together: bool = False,
) -> DataFrame:
    """``[id, _block, _words]``: words in order, NULL words dropped.

    A (document, block of positions) group has at most ``block_size`` rows,
    whatever the document. NULL words are skipped by the collecting step
    rather than by a filter, which would compute a derived word twice.
    ``together`` puts the blocks of a document into one partition, for steps that
    string them together: the words are then moved once.
    """
    named = tokens.select(id_col, order_col, F.col(word_col).alias("_w"))
    if can_run(named, id_col, order_col, ["_w"]):
        runs = token_runs(
            named, id_col=id_col, order_col=order_col, item_cols=["_w"], block_size=block_size, skip_null="_w"
        )
        runs = packed_runs(runs, ["_w"])
        dealt = runs.repartition(id_col) if together else runs.repartition(id_col, "_block")
        blocks = _run_items(dealt, id_col, "long", "_at", ["_w"])
        return blocks.select(id_col, "_block", F.col("_items")["_w"].alias("_words"))
    items = named.select(
        id_col,
        block_of(F.col(order_col), block_size).alias("_block"),
        F.when(F.col("_w").isNotNull(), F.struct(F.col(order_col).alias("_at"), "_w")).alias("_item"),
    )
    blocks = items.groupBy(id_col, "_block").agg(
        _in_order(F.collect_list("_item"), "_w").alias("_words")
    )
    return blocks.where(F.size("_words") > 0)


def word_lists(
    tokens: DataFrame,
    *,
    id_col: str = "doc_id",
    order_col: str = "token_id",
    word_col: str = "word",
    block_size: int = TOKENS_PER_BLOCK,
) -> DataFrame:
    """``[doc_id, words]``: words in position order, NULL words dropped.

    Documents without a word do not appear. Sorting happens in bounded
    (document, block) groups; the second step only strings the blocks of a
    document together, since a row per document is the result asked for.
    """
    require_columns(tokens, [id_col, order_col, word_col], "word_lists")
    blocks = word_blocks(
        tokens, id_col=id_col, order_col=order_col, word_col=word_col, block_size=block_size, together=True
    )
    return blocks.groupBy(id_col).agg(
        F.flatten(_in_order(F.collect_list(F.struct("_block", "_words")), "_words")).alias("words")
    )


def _whole_lists() -> Column:
    return F.flatten(_in_order(F.collect_list(F.struct("_block", "_items")), "_items")).cast(TOKEN_LIST)


def collect_tokens(
    tokens: DataFrame, *, block_size: int = TOKENS_PER_BLOCK
) -> DataFrame:
    """``[doc_id, tokens]``: the whole token rows of a document as one sorted list."""
    names = [f.name for f in TOKEN_STRUCT]
    if can_run(tokens, "doc_id", "token_id", names[1:]):
        runs, order_type = _whole_runs(tokens, block_size)
        blocks = _run_items(runs.repartition("doc_id"), "doc_id", order_type, "token_id", names[1:])
    else:
        items = tokens.select(
            "doc_id", block_of(F.col("token_id"), block_size).alias("_block"), F.struct(*names).alias("_item")
        )
        blocks = items.groupBy("doc_id", "_block").agg(
            F.sort_array(F.collect_list("_item")).alias("_items")
        )
    return blocks.groupBy("doc_id").agg(_whole_lists().alias("tokens"))


def _whole_runs(tokens: DataFrame, block_size: int) -> tuple[DataFrame, str]:
    names = [f.name for f in TOKEN_STRUCT][1:]
    runs = token_runs(tokens, id_col="doc_id", order_col="token_id", item_cols=names, block_size=block_size)
    return packed_runs(runs, names), tokens.schema["token_id"].dataType.simpleString()


def collect_known(
    tokens: DataFrame, documents: DataFrame, *, carry: tuple[str, ...] = (), block_size: int = TOKENS_PER_BLOCK
) -> DataFrame:
    """``[doc_id, tokens, known, n, <carry>]``: lists of the documents named, of others the number of rows.

    Any share of the rows may have no or an unknown document, and no row needs
    to hold them all. The documents meet the rows before they are regrouped.
    """
    known = documents.select("doc_id", *carry).where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    known = known.withColumn("known", F.lit(True))
    names = [f.name for f in TOKEN_STRUCT]
    if can_run(tokens, "doc_id", "token_id", names[1:]):
        runs, order_type = _whole_runs(tokens, block_size)
        size, kept = F.size("_run.number"), "_run"
        rows = runs.repartition("doc_id").join(known, "doc_id", "left")
        items = expanded(F.col("_kept"), order_type, "token_id", names[1:])
    else:
        rows = tokens.select(
            "doc_id", block_of(F.col("token_id"), block_size).alias("_block"), F.struct(*names).alias("_item")
        ).join(known, "doc_id", "left")
        size, kept, items = F.lit(1), "_item", F.col("_kept")
    blocks = rows.groupBy("doc_id", "_block").agg(
        F.collect_list(F.when(F.col("known"), F.col(kept))).alias("_kept"),
        F.sum(size).alias("_n"),
        *[F.max(c).alias(c) for c in ("known", *carry)],
    )
    blocks = blocks.select("doc_id", "_block", "known", "_n", *carry, F.sort_array(items).alias("_items"))
    return blocks.groupBy("doc_id").agg(
        _whole_lists().alias("tokens"),
        F.coalesce(F.max("known"), F.lit(False)).alias("known"),
        F.sum("_n").alias("n"),
        *[F.max(c).alias(c) for c in carry],
    )


def tokens_to_text(
    tokens: DataFrame,
    *,
    sep: str = " ",
    pos_keep=None,
    pos_exclude=None,
    stopwords=None,
    strict: bool = True,
    id_col: str = "doc_id",
    order_col: str = "token_id",
    word_col: str = "word",
    block_size: int = TOKENS_PER_BLOCK,
) -> DataFrame:
    """``[doc_id, text]``: the remaining words of a document joined in order."""
    kept = filter_tokens(
        tokens,
        pos_keep=pos_keep,
        pos_exclude=pos_exclude,
        stopwords=stopwords,
        strict=strict,
        word_col=word_col,
    )
    blocks = word_blocks(
        kept, id_col=id_col, order_col=order_col, word_col=word_col, block_size=block_size, together=True
    ).select(id_col, "_block", F.concat_ws(sep, "_words").alias("_part"))
    parts = _in_order(F.collect_list(F.struct("_block", "_part")), "_part")
    return blocks.groupBy(id_col).agg(F.concat_ws(sep, parts).alias("text"))


def write_corpus_text(
    tokens: DataFrame, path: str, *, sep: str = " ", id_col: str = "doc_id", **options
) -> None:
    """The corpus as text files, one line per document in id order."""
    lines = tokens_to_text(tokens, sep=sep, id_col=id_col, **options)
    ordered = lines.repartitionByRange(id_col).sortWithinPartitions(id_col)
    ordered.select(F.col("text").alias("value")).write.mode("overwrite").text(path)


def corpus_text(
    tokens: DataFrame, *, sep: str = " ", max_chars: int | None = None, id_col: str = "doc_id", **options
) -> str:
    """The whole corpus as one string, in memory of the driver.

    A caller who wants a bound gives ``max_chars``, which is summed on the
    cluster first; ``write_corpus_text`` needs no memory.
    """
    lines = tokens_to_text(tokens, sep=sep, id_col=id_col, **options)
    if max_chars is not None:
        total = lines.agg(F.sum(F.length("text") + len(sep))).first()[0] or 0
        if total > max_chars:
            raise ValueError(f"corpus has {total} characters; use write_corpus_text")
    return sep.join(r["text"] for r in lines.orderBy(id_col).toLocalIterator())


def read_range(
    tokens: DataFrame, start: int, size: int, *, id_col: str = "doc_id"
) -> DataFrame:
    """Tokens of ids in ``[start, start + size)``; pushed down to the scan."""
    return tokens.where((F.col(id_col) >= start) & (F.col(id_col) < start + size))


class CorpusReader:
    """Re-iterable word lists per document, in id then position order.

    ``frame`` is the distributed form; iterating streams it partition by
    partition to a notebook. ``lists`` are ``[doc_id, words]`` rows that are
    there already, in place of a long token table.
    """

    def __init__(
        self,
        tokens: DataFrame | None,
        *,
        id_col: str = "doc_id",
        word_col: str = "word",
        token_id_col: str = "token_id",
        return_mode: str = "tokens",
        lists: DataFrame | None = None,
    ):
        if return_mode not in RETURN_MODES:
            raise ValueError(f"return_mode must be one of {RETURN_MODES}")
        self.return_mode = return_mode
        self._id_col = id_col
        self._lists = lists
        if tokens is not None:
            self._lists = word_lists(tokens, id_col=id_col, order_col=token_id_col, word_col=word_col)

    @property
    def frame(self) -> DataFrame | None:
        if self._lists is None or self.return_mode == "id_tokens":
            return self._lists
        return self._lists.select("words")

    def __iter__(self):
        if self._lists is None:
            return
        for row in self._lists.orderBy(self._id_col).toLocalIterator():
            words = list(row["words"])
            yield words if self.return_mode == "tokens" else (row[self._id_col], words)


def corpus_reader(tokens: DataFrame | None, **options) -> CorpusReader:
    return CorpusReader(tokens, **options)
