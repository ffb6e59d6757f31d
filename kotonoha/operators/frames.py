"""Results of opaque Python functions: checked by column, returned as Arrow.

Work is cut by cumulative sizes, so that few texts or tokens are Python objects
at one time. A rule that a document breaks is reported for that document; a row
that belongs to none of the documents given makes the whole call fail.
"""

from __future__ import annotations

import json
import traceback
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kotonoha.schemas import TOKEN_LIST

TOKEN_FIELDS = [
    pa.field("token_id", pa.int32()),
    pa.field("word", pa.string()),
    pa.field("pos", pa.string()),
    pa.field("token_info", pa.string()),
]
MAX_TOKEN_ID = np.iinfo(np.int32).max

# Characters or tokens of a batch that are Python objects at one time.
SLICE_SIZE = 1_000_000


def size_cuts(sizes: Iterable[int], limit: int, most: int, keys: list | None = None) -> Iterator[tuple[int, int]]:
    """(begin, end) of neighbouring rows within ``limit`` in sum and ``most`` in number.

    A row above the limit stands alone. With ``keys`` no key is twice in a span.
    """
    sums = np.concatenate([[0], np.cumsum(np.asarray(list(sizes), np.int64))])
    n = len(sums) - 1
    before = np.full(n, -1)
    if keys is not None:
        last: dict = {}
        for i, key in enumerate(keys):
            before[i] = last.get(key, -1)
            last[key] = i
    begin = 0
    while begin < n:
        end = int(np.searchsorted(sums, sums[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), begin + most, n)
        repeated = np.flatnonzero(before[begin:end] >= begin)
        if len(repeated):
            end = begin + int(repeated[0])
        yield begin, end
        begin = end


def as_text(value: Any) -> str | None:
    """Text of a value; dictionaries and lists as JSON, missing as None."""
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, (dict, list)):
        return json.dumps(value, ensure_ascii=False)
    return None if value is pd.NA or value != value else str(value)


def text_array(values: Iterable) -> tuple[pa.Array, np.ndarray]:
    """Arrow strings, and a mask of texts that are no valid Unicode (NULL in the array)."""
    texts = [as_text(v) for v in values]
    try:
        return pa.array(texts, pa.string()), np.zeros(len(texts), bool)
    except UnicodeError:
        whole = np.array([t is not None and any(0xD800 <= ord(c) < 0xE000 for c in t) for t in texts])
        return pa.array([None if bad else t for t, bad in zip(texts, whole)], pa.string()), whole


def token_rows(frame: Any, keys: list, places: list[int], required: tuple[str, ...] = ("doc_id", "word")):
    """(places, columns, broken) of a token frame made for documents with these keys.

    ``columns`` are TOKEN_FIELDS in document order, ``places`` the owner of each
    row and ``broken`` the first broken rule by place; rows of broken documents
    are left out. A missing token_id column is filled 1-based in row order.
    """
    if not isinstance(frame, pd.DataFrame):
        raise TypeError("a token function must return a pandas DataFrame")
    if absent := [c for c in required if len(frame) and c not in frame.columns]:
        raise KeyError(f"token frame lacks {absent}")
    size = len(frame)
    of = dict(zip(keys, places, strict=True))
    owner = np.array([of.get(key, -1) for key in frame["doc_id"].tolist()] if size else [], np.int64)
    if (owner < 0).any():
        raise ValueError("token frame has rows without a doc_id or of documents outside its batch")
    order = np.argsort(owner, kind="stable")
    owner = owner[order]

    def values(name: str) -> np.ndarray:
        given = frame[name].to_numpy(object) if name in frame.columns else np.full(size, None, object)
        return given[order]

    first = np.searchsorted(owner, owner)
    missing = np.zeros(size, bool)
    numbers = np.arange(size) - first + 1
    if "token_id" in frame.columns:
        given = pd.to_numeric(pd.Series(values("token_id"), dtype=object), errors="coerce")
        missing = given.isna().to_numpy()
        numbers = given.fillna(0).to_numpy(np.float64)
    by_number = np.lexsort((numbers, owner))
    same = np.zeros(size, bool)
    same[by_number[1:]] = (np.diff(owner[by_number]) == 0) & (np.diff(numbers[by_number]) == 0)
    columns, invalid = [], np.zeros(size, bool)
    for name in ("word", "pos", "token_info"):
        column, bad = text_array(values(name))
        columns.append(column)
        invalid |= bad
    no_word = np.asarray(columns[0].is_null()) & ("token_id" in required) & ~invalid
    rules = {
        "NULL token_id, or one that is no number": missing,
        "token_id beyond 32 bits or not whole": (np.abs(numbers) > MAX_TOKEN_ID) | (numbers != np.floor(numbers)),
        "repeats a token_id": same,
        "NULL word": no_word,
        "text that is no valid Unicode": invalid,
    }
    broken: dict[int, str] = {}
    for rule, mask in rules.items():
        for place in np.unique(owner[mask]).tolist():
            broken.setdefault(place, f"token frame: {rule}")
    good = ~np.isin(owner, list(broken))
    kept = pa.array(np.flatnonzero(good))
    ids = pa.array(numbers[good].astype(np.int32))
    return owner[good], [ids, *[c.take(kept) for c in columns]], broken


def run_spans(spans: Iterable[tuple[int, int]], attempt: Callable, fallback: bool = True):
    """Call ``attempt(places)`` on spans, in halves after a failure.

    Of n documents k bad ones cost about k log n calls more. Returns (places, columns) of all rows and errors by place.
    """
    results, errors = [], {}
    for begin, end in spans:
        todo = [list(range(begin, end))]
        while todo:
            places = todo.pop(0)
            try:
                *found, broken = attempt(places)
            except Exception:
                if len(places) > 1 and fallback:
                    half = len(places) // 2
                    todo[:0] = [places[:half], places[half:]]
                elif not fallback:
                    raise
                else:
                    errors[places[0]] = traceback.format_exc()
                continue
            errors |= broken
            results.append(found)
    if not results:
        return np.zeros(0, np.int64), [pa.array([], f.type) for f in TOKEN_FIELDS], errors
    owners = np.concatenate([r[0] for r in results])
    columns = [pa.concat_arrays([r[1][k] for r in results]) for k in range(len(TOKEN_FIELDS))]
    return owners, columns, errors


def result_batch(
    source: pa.RecordBatch, columns: list[pa.Array], counts, errors: dict[int, str]
) -> pa.RecordBatch:
    """Id, tokens, error and the carried columns (all after the second) of a batch.

    ``columns`` are the token fields of all documents in order, ``counts`` the
    tokens per document; a failed document gets a NULL list.
    """
    size = source.num_rows
    offsets = np.concatenate([[0], np.cumsum(np.asarray(counts, dtype=np.int64))])
    tokens = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()),
        pa.StructArray.from_arrays(columns, fields=TOKEN_FIELDS),
        mask=pa.array(np.isin(np.arange(size), list(errors))),
    )
    carried = range(2, source.num_columns)
    return pa.RecordBatch.from_arrays(
        [
            source.column(0),
            tokens,
            pa.array([errors.get(i) for i in range(size)], type=pa.string()),
            *[source.column(i) for i in carried],
        ],
        names=["doc_id", "tokens", "error", *[source.schema.names[i] for i in carried]],
    )


def result_schema(source: DataFrame) -> T.StructType:
    """Schema that goes with ``result_batch``."""
    return T.StructType(
        [
            source.schema[0],
            T.StructField("tokens", TOKEN_LIST),
            T.StructField("error", T.StringType()),
            *source.schema.fields[2:],
        ]
    )
