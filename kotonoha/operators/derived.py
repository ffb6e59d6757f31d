"""Derived token tables: a transform over tokens with the fixed schema enforced."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kotonoha.operators.frames import (
    SLICE_SIZE,
    result_batch,
    result_schema,
    run_spans,
    size_cuts,
    token_rows,
)
from kotonoha.operators.reader import collect_known
from kotonoha.operators.tokenize import explode_lists
from kotonoha.plans.layout import fix_wide
from kotonoha.schemas import TOKEN_COLUMNS, require_columns

# --------------------------------------------------------------------------
# declarative form: DataFrame -> DataFrame
# --------------------------------------------------------------------------


def fit_schema(tokens: DataFrame) -> DataFrame:
    """Fixed columns and types: missing pos / token_info become NULL, extras go.

    Structured token_info is written as JSON text.
    """
    require_columns(tokens, ["doc_id", "token_id", "word"], "fit_schema")
    info_type = tokens.schema["token_info"].dataType if "token_info" in tokens.columns else None
    structured = isinstance(info_type, (T.StructType, T.MapType, T.ArrayType))

    def column(name: str) -> Column:
        if name not in tokens.columns:
            return F.lit(None).cast("string").alias(name)
        if name == "token_info" and structured:
            return F.to_json(name).alias(name)
        return F.col(name)

    types = {"token_id": "int", "word": "string", "pos": "string", "token_info": "string"}
    picked = [
        column(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in TOKEN_COLUMNS
    ]
    return tokens.select(*picked)


def token_problems(
    tokens: DataFrame, documents: DataFrame, *, require_word: bool = True
) -> DataFrame:
    """``[doc_id, problem, n]``: broken rules of a token table, one row each.

    Problems: null_key, null_word, foreign_doc, duplicate. The duplicate test
    counts per (doc_id, token_id) first, so one key's copies meet as a partial
    count; the foreign test joins one row per document.
    """
    one = F.lit(1)
    bad_key = F.col("doc_id").isNull() | F.col("token_id").isNull()
    per_position = tokens.groupBy("doc_id", "token_id").agg(
        F.count(one).alias("_n"), F.count_if(F.col("word").isNull()).alias("_no_word")
    )
    per_doc = per_position.groupBy("doc_id").agg(
        F.sum(F.when(bad_key, F.col("_n"))).alias("null_key"),
        F.sum("_no_word").alias("null_word"),
        F.sum(F.when(~bad_key & (F.col("_n") > 1), F.col("_n"))).alias("duplicate"),
        F.sum("_n").alias("_rows"),
    )
    known = documents.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    joined = per_doc.join(known.withColumn("_known", F.lit(True)), "doc_id", "left")
    foreign = F.when(F.col("_known").isNull() & F.col("doc_id").isNotNull(), F.col("_rows"))
    names = ["null_key", "duplicate", "foreign_doc", *(["null_word"] if require_word else [])]
    listed = joined.withColumn("foreign_doc", foreign).select(
        "doc_id",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("problem"), F.col(n).alias("n")) for n in names])
        ).alias("p"),
    )
    return listed.select("doc_id", "p.problem", "p.n").where(F.col("n") > 0)


def derive_tokens(
    tokens: DataFrame,
    documents: DataFrame,
    transform: Callable[[DataFrame], DataFrame | None],
) -> tuple[DataFrame, DataFrame]:
    """Apply ``transform`` and split by the rules.

    Returns the accepted token rows and ``[doc_id, ok, error]`` with one row per
    document: a document that breaks a rule loses its rows and gets an error,
    all others are marked done, also when no token is left.
    """
    if not callable(transform):
        raise TypeError("transform must be callable")
    result = transform(tokens)
    out = fit_schema(tokens.limit(0) if result is None else result)
    # Regrouped and fixed once: the transform runs once, the rules are read off the lists.
    lists = collect_known(out, documents)
    foreign = F.when(~F.col("known"), F.lit("foreign_doc"))
    problems = F.array_sort(F.array_compact(F.array(foreign, *list_problems(F.col("tokens")))))
    judged = fix_wide(
        lists.select("doc_id", "tokens", F.nullif(F.array_join(problems, ", "), F.lit("")).alias("error"))
    )
    accepted = explode_lists(judged.where("doc_id IS NOT NULL AND error IS NULL")).select(*TOKEN_COLUMNS)
    errors = judged.where("error IS NOT NULL").select("doc_id", "error")
    status = documents.select("doc_id").join(errors, "doc_id", "left").select(
        "doc_id", F.col("error").isNull().alias("ok"), "error"
    )
    return accepted, status


def list_problems(tokens: Column) -> list[Column]:
    """Names of the token rules that a document's list breaks, NULL for one it keeps."""
    ids = F.filter(tokens["token_id"], lambda i: i.isNotNull())
    return [
        F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.lit("duplicate")),
        F.when(F.size(ids) < F.size(tokens), F.lit("null_key")),
        F.when(F.exists(tokens["word"], lambda w: w.isNull()), F.lit("null_word")),
    ]


# --------------------------------------------------------------------------
# opaque form: pandas DataFrame -> pandas DataFrame
# --------------------------------------------------------------------------


def derive_lists(
    lists: DataFrame,
    transform: Callable[[pd.DataFrame], pd.DataFrame | None],
    *,
    max_docs: int = 500,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Apply a pandas transform to ``[doc_id, tokens]`` rows, without a shuffle.

    Returns ``[doc_id, tokens, error, <carry>]``. Up to ``max_docs`` documents
    with SLICE_SIZE tokens in all are passed at once. When the call fails, or
    returns rows of other documents, they are repeated one by one, so only the
    failing document carries an error.
    """
    if not callable(transform):
        raise TypeError("transform must be callable")
    require_columns(lists, ["doc_id", "tokens"], "derive_lists")

    def derived(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, spans = _flat_tokens(batch)

        def attempt(places: list[int]):
            # Neighbouring documents are one slice of the flat frame.
            begin, end = spans[places[0]][1], spans[places[-1]][2]
            frame = transform(flat.iloc[begin:end].reset_index(drop=True))
            if frame is None:
                frame = pd.DataFrame(columns=TOKEN_COLUMNS)
            keys = [spans[p][0] for p in places]
            return token_rows(frame, keys, places, ("doc_id", "token_id", "word"))

        sizes = [end - begin for _, begin, end in spans]
        cuts = size_cuts(sizes, SLICE_SIZE, max_docs, [s[0] for s in spans])
        owners, columns, errors = run_spans(cuts, attempt)
        return result_batch(batch, columns, np.bincount(owners, minlength=batch.num_rows), errors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_pylist()
            for begin, end in size_cuts(sizes, SLICE_SIZE, batch.num_rows):
                yield derived(batch.slice(begin, end - begin))

    source = lists.select("doc_id", "tokens", *carry)
    return source.mapInArrow(run, result_schema(source))


def _flat_tokens(batch: pa.RecordBatch) -> tuple[pd.DataFrame, list[tuple]]:
    """All tokens of a batch as one frame, and (doc_id, begin, end) of every row."""
    lists = batch.column(1)
    counts = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    flat = pa.RecordBatch.from_struct_array(lists.flatten()).to_pandas()
    flat.insert(0, "doc_id", np.repeat(batch.column(0).to_pandas().to_numpy(), counts))
    ends = np.cumsum(counts)
    return flat, list(zip(batch.column(0).to_pylist(), ends - counts, ends))
