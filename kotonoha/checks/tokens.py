"""Tokenizing, filtering, rewriting and reading tokens."""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from kotonoha.checks.common import (
    SPACES,
    SQL_VARIANT_INPUT,
    doc_tokens,
    documents,
    registry,
    scratch,
    sql_tokens,
    table,
    variant_input,
    with_tokens,
)
from kotonoha.functions.text import SPLIT_MAX_LENGTH, has_content, strip_text
from kotonoha.functions.words import coarse_pos_from_info
from kotonoha.operators.derived import derive_lists, derive_tokens
from kotonoha.operators.filters import drop_frequent_words, filter_tokens
from kotonoha.operators.frequency import id_range, pos_distribution, term_frequency
from kotonoha.operators.lists import LIST_VARIANTS, filter_lists, select_form_in_lists, text_of_lists
from kotonoha.operators.reader import (
    collect_tokens,
    corpus_reader,
    read_range,
    tokens_to_text,
    word_lists,
    write_corpus_text,
)
from kotonoha.operators.tokenize import (
    ArrowTokenizer,
    FrameTokenizer,
    explode_lists,
    select_word_form,
    split_text,
    tokenize,
    text_tokenizer,
    tokenize_lists,
)
from kotonoha.operators.variants import VARIANTS
from kotonoha.schemas import TOKEN_LIST
from kotonoha.sources.sinks import read_tokens, write_document_tokens

QUERIES, ORACLES, check = registry()


PER_DOC_TEXT = "SELECT doc_id, string_agg(word, ' ' ORDER BY token_id) AS text FROM {} GROUP BY doc_id"


@check("tokenize", with_tokens("SELECT doc_id, token_id, word, pos FROM tok"))
def _(spark, folder):
    return doc_tokens(spark, folder, info_col=None)


def split_on_space(text: str):
    return [(w, "run", {"surface": w}) for w in re.findall(r"[^ \n]+", text)]


SPLIT_TOKENS = """
  SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS token_id
  FROM (SELECT doc_id, regexp_extract_all(regexp_replace(text, '^[{s}]+|[{s}]+$', '', 'g'),
               '[^ \\n]+') AS ws FROM documents)""".format(s=SPACES)


@check(
    "tokenize_function",
    f"""SELECT doc_id, count(*) AS n_tokens, max(token_id) AS last_id, min(word) AS first_word,
               max(word) AS last_word
        FROM ({SPLIT_TOKENS}) GROUP BY doc_id""",
)
def _(spark, folder):
    """A caller's Python tokenizer, run in Arrow batches."""
    return _spans(tokenize(documents(spark, folder), tokenizer=split_on_space))


def _spans(tokens):
    return tokens.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.max(F.col("token_id").cast("long")).alias("last_id"),
        F.min("word").alias("first_word"),
        F.max("word").alias("last_word"),
    )


def arrow_split_on_space(texts: pa.Array) -> pa.Array:
    """The same tokens from whole columns."""
    lists = pc.split_pattern_regex(texts, "[ \n]+")
    words = lists.flatten()
    some = pc.not_equal(words, "")
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    offsets = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()].astype(np.int32)
    kept = words.filter(some)
    runs = pa.array(np.full(len(kept), "run", object), pa.string())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([kept, runs], ["word", "pos"]))


@check("tokenize_arrow", ORACLES["tokenize_function"])
def _(spark, folder):
    """A caller's tokenizer on Arrow columns."""
    tokenizer = ArrowTokenizer(lambda: arrow_split_on_space)
    return _spans(tokenize(documents(spark, folder), tokenizer=tokenizer))


def split_or_die(text: str):
    if len(text) > 40_000:
        os._exit(1)
    return split_on_space(text)


@check(
    "tokenize_isolated",
    f"""SELECT d.doc_id, any_value(length(text)) > 40000 AS failed,
               CASE WHEN any_value(length(text)) > 40000 THEN NULL ELSE count(word) END AS n_tokens
        FROM (SELECT doc_id, regexp_replace(text, '^[{SPACES}]+|[{SPACES}]+$', '', 'g') AS text FROM documents) d
        LEFT JOIN ({SPLIT_TOKENS}) t ON t.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def _(spark, folder):
    """A tokenizer that kills its process on long texts: these documents get an error."""
    lists = tokenize_lists(documents(spark, folder), text_tokenizer(split_or_die, time_limit=60))
    return lists.select(
        "doc_id", F.col("error").isNotNull().alias("failed"), F.size("tokens").cast("long").alias("n_tokens")
    )


def frame_or_fail(frame: pd.DataFrame) -> pd.DataFrame:
    """A frame tokenizer without token_id that refuses texts with an at sign."""
    if frame["text"].str.contains("@", regex=False).any():
        raise ValueError("at sign")
    rows = [(d, w) for d, t in zip(frame["doc_id"], frame["text"]) for w in re.findall(r"[^ \n]+", t)]
    return pd.DataFrame(rows, columns=["doc_id", "word"])


@check(
    "tokenize_frame",
    """SELECT doc_id, contains(text, '@') AS failed,
              CASE WHEN NOT contains(text, '@') THEN CAST(len(regexp_extract_all(text, '[^ \\n]+')) AS BIGINT) END AS n_tokens,
              CASE WHEN NOT contains(text, '@') AND regexp_matches(text, '[^ \\n]') THEN 1 END AS first_id
       FROM documents""",
)
def _(spark, folder):
    """Batch tokenizer: failing documents are isolated, ids filled from 1."""
    lists = tokenize_lists(documents(spark, folder), FrameTokenizer(frame_or_fail))
    return lists.select(
        "doc_id",
        F.col("error").isNotNull().alias("failed"),
        F.when(F.col("error").isNull(), F.size("tokens")).cast("long").alias("n_tokens"),
        F.array_min("tokens.token_id").alias("first_id"),
    )


@check(
    "word_form",
    with_tokens(
        "SELECT doc_id, string_agg(lower(word), ' ' ORDER BY token_id) AS text FROM tok GROUP BY doc_id"
    ),
)
def _(spark, folder):
    return tokens_to_text(select_word_form(doc_tokens(spark, folder), "norm"))


@check("coarse_pos", with_tokens("SELECT pos, count(*) AS count FROM tok GROUP BY pos"))
def _(spark, folder):
    tokens = doc_tokens(spark, folder).withColumn("pos", coarse_pos_from_info(F.col("token_info")))
    return pos_distribution(tokens)


@check("word_form_typed", ORACLES["word_form"])
def _(spark, folder):
    """The form read by path from a token_info that is VARIANT: no JSON on the way."""
    return tokens_to_text(select_word_form(doc_tokens(spark, folder, variant_info=True), "norm"))


@check("coarse_pos_typed", ORACLES["coarse_pos"])
def _(spark, folder):
    tokens = doc_tokens(spark, folder, variant_info=True)
    return pos_distribution(tokens.withColumn("pos", coarse_pos_from_info(F.col("token_info"), variant=True)))


# One recursion step per piece; the last delimiter is found from the tail that
# has none.
_WINDOW = f"substr(rest, {int(SPLIT_MAX_LENGTH * 0.9) + 1}, {SPLIT_MAX_LENGTH - int(SPLIT_MAX_LENGTH * 0.9)})"
_CUTS = " ".join(
    f"WHEN contains({_WINDOW}, '{d}') THEN {SPLIT_MAX_LENGTH} - length(regexp_extract({_WINDOW}, '[^{d}]*$'))"
    for d in ("\n", "。", "、")
)
SPLIT_SQL = f"""
WITH RECURSIVE step AS (
  SELECT doc_id, -1 AS chunk_id, '' AS chunk, text AS rest FROM documents WHERE text <> ''
  UNION ALL
  SELECT doc_id, chunk_id + 1, substr(rest, 1, cut), substr(rest, cut + 1)
  FROM (SELECT doc_id, chunk_id, rest,
               CASE WHEN length(rest) <= {SPLIT_MAX_LENGTH} THEN length(rest) {_CUTS}
                    ELSE {SPLIT_MAX_LENGTH} END AS cut
        FROM step WHERE rest <> ''))
SELECT doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, chunk FROM step WHERE chunk_id >= 0"""


@check("split_text", SPLIT_SQL)
def _(spark, folder):
    return split_text(documents(spark, folder))


@check(
    "strip_text",
    f"""SELECT conv_id, turn, regexp_replace(padded, '^[{SPACES}]+|[{SPACES}]+$', '', 'g') AS text,
               regexp_matches(partly, '[^{SPACES}]') AS has_content
        FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN chr(12288) || chr(10) || text || chr(28) || chr(160)
                                         ELSE chr(8195) || text || chr(9) END AS padded,
                     CASE WHEN role = 'user' THEN text ELSE chr(8195) || chr(9) END AS partly FROM conversations)""",
)
def _(spark, folder):
    padded = F.when(
        F.col("role") == "user", F.concat(F.lit("　\n"), F.col("text"), F.lit("\x1c\xa0"))
    ).otherwise(F.concat(F.lit("\u2003"), F.col("text"), F.lit("\t")))
    partly = F.when(F.col("role") == "user", F.col("text")).otherwise(F.lit("\u2003\t"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", strip_text(padded).alias("text"), has_content(partly).alias("has_content")
    )


# -- filters -----------------------------------------------------------------


@check("filter_keep", with_tokens(PER_DOC_TEXT.format("tok") .replace("FROM tok", "FROM tok WHERE pos IN ('word', 'number')")))
def _(spark, folder):
    return tokens_to_text(doc_tokens(spark, folder), pos_keep=["word", "number"])


@check(
    "filter_exclude_null",
    with_tokens(
        """SELECT pos, count(*) AS count FROM (SELECT nullif(pos, 'number') AS pos FROM tok)
           WHERE pos IS NULL OR pos <> 'symbol' GROUP BY pos"""
    ),
)
def _(spark, folder):
    tokens = doc_tokens(spark, folder).withColumn("pos", F.nullif("pos", F.lit("number")))
    return pos_distribution(filter_tokens(tokens, pos_exclude="symbol"))


@check(
    "stopwords_union",
    f"""WITH tok AS ({sql_tokens()}), bench AS ({sql_tokens("benchmark", "item_id")})
        SELECT word, count(*) AS count FROM tok
        WHERE word NOT IN (SELECT word FROM bench) AND word NOT IN ('der', 'und', 'la', '.')
        GROUP BY word""",
)
def _(spark, folder):
    from_table = tokenize(table(spark, folder, "benchmark"), id_col="item_id").select("word")
    mixed = ["der", ["und", ("la",)], {".": 3}, from_table]
    kept = filter_tokens(doc_tokens(spark, folder), stopwords=mixed)
    return term_frequency(kept, ordered=False)


@check(
    "stopwords_topk",
    with_tokens(
        """, top AS (SELECT word FROM tok GROUP BY word ORDER BY count(*) DESC, word LIMIT 25)
           SELECT word, count(*) AS count FROM tok WHERE word NOT IN (FROM top) GROUP BY word"""
    ),
)
def _(spark, folder):
    return term_frequency(drop_frequent_words(doc_tokens(spark, folder), 25), ordered=False)


@check("tokens_to_text", with_tokens(PER_DOC_TEXT.format("tok")))
def _(spark, folder):
    return tokens_to_text(doc_tokens(spark, folder))


@check("corpus_text_files", with_tokens(f"SELECT text FROM ({PER_DOC_TEXT.format('tok')})"))
def _(spark, folder):
    """The corpus text as files, read back line by line."""
    path = scratch(spark, "corpus-text")
    write_corpus_text(doc_tokens(spark, folder), path)
    return spark.read.text(path).withColumnRenamed("value", "text")


@check("token_sink", with_tokens("SELECT doc_id, token_id, word, pos FROM tok"))
def _(spark, folder):
    """ZSTD Parquet copy of the token table, read back."""
    path = scratch(spark, "tokens")
    write_document_tokens(documents(spark, folder), path)
    return read_tokens(spark, path).drop("token_info")


# -- reads -------------------------------------------------------------------

NULLED = "SELECT doc_id, token_id, CASE WHEN pos <> 'symbol' THEN word END AS word FROM tok"


def _nulled(spark, folder):
    tokens = doc_tokens(spark, folder)
    return tokens.withColumn("word", F.when(F.col("pos") != "symbol", F.col("word")))


@check(
    "word_lists",
    with_tokens(
        f"""SELECT doc_id, array_to_string(list(word ORDER BY token_id), '|') AS words, count(*) AS n_words
            FROM ({NULLED}) WHERE word IS NOT NULL GROUP BY doc_id"""
    ),
)
def _(spark, folder):
    """Word array per document, NULL words dropped."""
    lists = word_lists(_nulled(spark, folder))
    return lists.select(
        "doc_id", F.array_join("words", "|").alias("words"), F.size("words").cast("long").alias("n_words")
    )


@check(
    "reader_tokens_only",
    with_tokens(
        f"""SELECT array_to_string(list(word ORDER BY token_id), '|') AS words
            FROM ({NULLED}) WHERE word IS NOT NULL GROUP BY doc_id"""
    ),
)
def _(spark, folder):
    lists = corpus_reader(_nulled(spark, folder), return_mode="tokens").frame
    return lists.select(F.array_join("words", "|").alias("words"))


@check("id_range", with_tokens("SELECT min(doc_id) AS min_id, max(doc_id) AS max_id FROM tok"))
def _(spark, folder):
    return id_range(doc_tokens(spark, folder, info_col=None))


@check(
    "range_reads",
    with_tokens(
        """, r AS (SELECT min(doc_id) AS lo, (max(doc_id) - min(doc_id)) // 4 + 1 AS size FROM tok)
           SELECT (doc_id - lo) // size AS part, count(*) AS n_tokens, count(DISTINCT doc_id) AS n_docs
           FROM tok, r GROUP BY part"""
    ),
)
def _(spark, folder):
    """Four half-open id ranges that cover the table, read as a chunked reader does."""
    tokens = doc_tokens(spark, folder, info_col=None)
    ends = id_range(table(spark, folder, "documents")).first()
    low, size = ends["min_id"], (ends["max_id"] - ends["min_id"]) // 4 + 1
    parts = [
        read_range(tokens, low + k * size, size).withColumn("part", F.lit(k).cast("long"))
        for k in range(4)
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    per_doc = union.groupBy("part", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("part").agg(
        F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs")
    )


# -- derived tables --------------------------------------------------------------

_SURFACE_WORD = "coalesce(surface, word)"
_NUM = "CASE WHEN regexp_matches({w}, '^\\p{{Nd}}+(\\.\\p{{Nd}}+)?$') THEN '[NUM]' ELSE {w} END"
VARIANT_SQL = {
    "filtered": f"""SELECT * FROM (SELECT doc_id, token_id, {_NUM.format(w='word')} AS word
                    FROM v WHERE pos NOT IN ('空白', '補助記号', '記号'))
                    WHERE NOT regexp_matches(word, '^([!-/:-@\\[-`{{-~]+|[ぁ-ん])$')""",
    "surface": f"SELECT doc_id, token_id, {_SURFACE_WORD} AS word FROM v WHERE pos <> '空白'",
    "hybrid": f"""SELECT doc_id, token_id, {_NUM.format(w='word')} AS word FROM (
                  SELECT doc_id, token_id,
                         CASE WHEN pos IN ('名詞', '形状詞', '接尾辞', '接頭辞') THEN word ELSE {_SURFACE_WORD} END AS word
                  FROM v WHERE pos NOT IN ('空白', '補助記号', '記号', '感動詞'))""",
}


def _variant_check(name: str) -> None:
    @check(
        f"variant_{name}",
        f"WITH v AS ({SQL_VARIANT_INPUT}), d AS ({VARIANT_SQL[name]}) {PER_DOC_TEXT.format('d')}",
    )
    def _(spark, folder):
        return tokens_to_text(VARIANTS[name](variant_input(spark, folder)))

    @check(f"variant_{name}_typed", ORACLES[f"variant_{name}"])
    def _(spark, folder):
        """The same with a token_info that is VARIANT."""
        return tokens_to_text(VARIANTS[name](variant_input(spark, folder, variant_info=True)))


for _name in VARIANTS:
    _variant_check(_name)


@check(
    "number_mask",
    with_tokens(
        f"""SELECT w AS word, count(*) AS count FROM (SELECT {_NUM.format(w='word')} AS w FROM tok)
            GROUP BY w"""
    ),
)
def _(spark, folder):
    from kotonoha.operators.variants import mask_number_words

    return term_frequency(mask_number_words(doc_tokens(spark, folder)), ordered=False)


@check(
    "variant_chain",
    f"""WITH v AS ({SQL_VARIANT_INPUT}), s AS ({VARIANT_SQL["surface"].replace("token_id,", "token_id, pos,")}),
             f AS (SELECT doc_id, token_id, word FROM s WHERE pos = '名詞')
        {PER_DOC_TEXT.format('f')}""",
)
def _(spark, folder):
    """Full table first, filters later: one derived table on top of another."""
    surface = VARIANTS["surface"](variant_input(spark, folder))
    return tokens_to_text(filter_tokens(surface, pos_keep="名詞"))


# -- the same on token lists ------------------------------------------------------


def _doc_lists(spark, folder, with_info=False):
    return tokenize_lists(documents(spark, folder), with_info=with_info)


@check("filter_keep_lists", ORACLES["filter_keep"])
def _(spark, folder):
    """Filter and join on the arrays, where the texts are read."""
    return text_of_lists(filter_lists(_doc_lists(spark, folder), pos_keep=["word", "number"]))


@check("tokens_to_text_lists", ORACLES["tokens_to_text"])
def _(spark, folder):
    return text_of_lists(_doc_lists(spark, folder))


@check("word_form_lists", ORACLES["word_form"])
def _(spark, folder):
    return text_of_lists(select_form_in_lists(_doc_lists(spark, folder, with_info=True), "norm"))


def _variant_lists(spark, folder):
    """The lists with the parts of speech that ``variant_input`` gives."""
    def token(t):
        word = t["word"]
        pos = (
            F.when(t["pos"] == "symbol", F.when(word == "-", F.lit("感動詞")).otherwise(F.lit("補助記号")))
            .when(t["pos"] == "number", F.lit("名詞"))
            .when(word.rlike(r"^\p{Lu}"), F.lit("動詞"))
            .otherwise(F.lit("名詞"))
        )
        return F.struct(
            t["token_id"].alias("token_id"), F.lower(word).alias("word"), pos.alias("pos"),
            t["token_info"].alias("token_info"),
        )

    return _doc_lists(spark, folder, with_info=True).withColumn("tokens", F.transform("tokens", token).cast(TOKEN_LIST))


def _variant_lists_check(name):
    @check(f"variant_{name}_lists", ORACLES[f"variant_{name}"])
    def _(spark, folder):
        return text_of_lists(LIST_VARIANTS[name](_variant_lists(spark, folder)))


for _name in LIST_VARIANTS:
    _variant_lists_check(_name)


def break_some(tokens):
    """Drops symbols; repeats positions of documents with a 'zz' word; empties words with 'q'."""
    kept = tokens.where("pos <> 'symbol'")
    token_id = F.when(F.col("word").contains("rr"), F.lit(0)).otherwise(F.col("token_id"))
    word = F.when(~F.col("word").contains("%"), F.col("word"))
    return kept.withColumn("token_id", token_id).withColumn(
        "word", F.when(F.col("word") != "Das", word)
    )


_BROKEN = """
  b AS (SELECT doc_id, CASE WHEN contains(word, 'rr') THEN 0 ELSE token_id END AS token_id,
               CASE WHEN word <> 'Das' THEN word END AS word
        FROM tok WHERE pos <> 'symbol'),
  dup AS (SELECT DISTINCT doc_id FROM b GROUP BY doc_id, token_id HAVING count(*) > 1),
  nul AS (SELECT DISTINCT doc_id FROM b WHERE word IS NULL)"""


@check(
    "derived_table",
    with_tokens(
        f""", {_BROKEN}
        SELECT d.doc_id,
               d.doc_id NOT IN (FROM dup) AND d.doc_id NOT IN (FROM nul) AS ok,
               nullif(concat_ws(', ', CASE WHEN d.doc_id IN (FROM dup) THEN 'duplicate' END,
                                      CASE WHEN d.doc_id IN (FROM nul) THEN 'null_word' END), '') AS error,
               CASE WHEN d.doc_id NOT IN (FROM dup) AND d.doc_id NOT IN (FROM nul)
                    THEN (SELECT string_agg(word, ' ' ORDER BY token_id) FROM b WHERE b.doc_id = d.doc_id) END AS text
        FROM documents d"""
    ),
)
def _(spark, folder):
    """Spark transform with the fixed schema enforced per document."""
    docs = documents(spark, folder)
    accepted, verdict = derive_tokens(doc_tokens(spark, folder), docs, break_some)
    return verdict.join(tokens_to_text(accepted), "doc_id", "left").select(
        "doc_id", "ok", "error", "text"
    )


def pandas_no_symbols(frame: pd.DataFrame) -> pd.DataFrame:
    if (frame["word"] == "Das").any():
        raise ValueError("refused")
    return frame[frame["pos"] != "symbol"]


@check(
    "derived_table_pandas",
    with_tokens(
        """, bad AS (SELECT DISTINCT doc_id FROM tok WHERE word = 'Das')
           SELECT doc_id, string_agg(word, ' ' ORDER BY token_id) AS text
           FROM tok WHERE pos <> 'symbol' AND doc_id NOT IN (FROM bad) GROUP BY doc_id"""
    ),
)
def _(spark, folder):
    """An opaque pandas transform: the failing documents drop out alone."""
    lists = tokenize_lists(documents(spark, folder))
    return tokens_to_text(explode_lists(derive_lists(lists, pandas_no_symbols)))


@check(
    "token_list_regroup",
    with_tokens("SELECT doc_id, count(*) AS n_tokens, max(token_id) AS last_id FROM tok GROUP BY doc_id"),
)
def _(spark, folder):
    """Long table back to one sorted token list per document."""
    lists = collect_tokens(doc_tokens(spark, folder))
    last = F.element_at("tokens", -1)["token_id"]
    return lists.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), last.alias("last_id"))
