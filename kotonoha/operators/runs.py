"""Neighbouring token rows of one document as one row, before they are shuffled.

A token table mostly lies in document order already. Here the rows of a document
(and block of positions) that stand together become one row with their different
items and two number arrays, where they are read. What meets in the shuffle is
then a few rows per document; rows in any other order are only more, shorter runs.
``packed_runs`` has the items of a run as one string per column, since an array of
them takes several times their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kotonoha.plans.layout import block_of

_IDS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)
_ORDERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)

# Between the items of a string, and for a NULL one; in items both are written behind a third.
_NEXT, _NONE, _ESCAPE = "\x01", "\x02", "\x03"
_ESCAPED = ((_ESCAPE, f"{_ESCAPE}c"), (_NEXT, f"{_ESCAPE}a"), (_NONE, f"{_ESCAPE}b"))
# Most rows of a run, so that item numbers take two bytes.
_RUN_ROWS = 32_767


def can_run(tokens: DataFrame, id_col: str, order_col: str, item_cols: list[str]) -> bool:
    """Whether these columns have types whose runs are found in Arrow."""
    kind = {f.name: f.dataType for f in tokens.schema}
    # Strings are compared by bytes, as other collations do not.
    texts = all(kind[c] == T.StringType() for c in item_cols)
    whole = not isinstance(kind[id_col], T.StringType) or kind[id_col] == T.StringType()
    return texts and whole and isinstance(kind[id_col], _IDS) and isinstance(kind[order_col], _ORDERS)


def token_runs(
    tokens: DataFrame,
    *,
    id_col: str,
    order_col: str,
    item_cols: list[str],
    block_size: int,
    skip_null: str | None = None,
) -> DataFrame:
    """``[id, _block, _run]`` of a token table.

    ``_run`` holds the positions, the item number of every token and the
    different items. Rows whose ``skip_null`` is NULL are left out.
    """
    rows = tokens.select(
        id_col,
        block_of(F.col(order_col), block_size).alias("_block"),
        F.col(order_col).cast("long").alias("_order"),
        *[F.col(c).alias(f"_item{k}") for k, c in enumerate(item_cols)],
    )
    skipped = None if skip_null is None else 3 + item_cols.index(skip_null)
    item = pa.struct([pa.field(c, pa.string()) for c in item_cols])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if skipped is not None and batch.column(skipped).null_count:
                batch = batch.filter(batch.column(skipped).is_valid())
            if batch.num_rows:
                yield merged(batch)

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = batch.num_rows
        new = np.zeros(size, bool)
        new[0] = True
        for k in (0, 1):
            new[1:] |= np.diff(_codes(batch.column(k))) != 0
        new[::_RUN_ROWS] = True
        starts = np.flatnonzero(new)
        # Different items within each run, in order of appearance.
        key = np.cumsum(new) - 1
        for k in range(3, batch.num_columns):
            codes = _codes(batch.column(k))
            key = pd.factorize(key * (int(codes.max()) + 1) + codes)[0].astype(np.int64)
        first = np.unique(key, return_index=True)[1]
        items = pa.StructArray.from_arrays(
            [batch.column(k).take(pa.array(first)) for k in range(3, batch.num_columns)], fields=list(item)
        )
        offsets = np.append(starts, size).astype(np.int32)
        item_offsets = np.append(np.searchsorted(first, starts), len(first)).astype(np.int32)
        owner = np.repeat(np.arange(len(starts)), np.diff(offsets))
        # As distances from the place in the run, which are mostly all the same.
        place = np.arange(size) - starts[owner]
        order = batch.column(2)
        known = order.is_valid().to_numpy(zero_copy_only=False)
        away = order.fill_null(0).to_numpy(zero_copy_only=False) - place
        number = (key - item_offsets[owner]).astype(np.int16)
        runs = pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(away, pa.int64(), mask=~known)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(number)),
                pa.ListArray.from_arrays(pa.array(item_offsets), items),
            ],
            names=["away", "number", "items"],
        )
        at = pa.array(starts)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), runs], names=[id_col, "_block", "_run"]
        )

    kept = T.StructType([T.StructField(c, T.StringType()) for c in item_cols])
    run_type = T.StructType(
        [
            T.StructField("away", T.ArrayType(T.LongType())),
            T.StructField("number", T.ArrayType(T.ShortType())),
            T.StructField("items", T.ArrayType(kept)),
        ]
    )
    schema = T.StructType([rows.schema[0], T.StructField("_block", T.LongType()), T.StructField("_run", run_type)])
    return rows.mapInArrow(run, schema)


def _codes(column: pa.Array) -> np.ndarray:
    """Equal values, NULL among them, as equal numbers."""
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def packed_runs(runs: DataFrame, item_cols: list[str]) -> DataFrame:
    """``token_runs`` as they are shuffled; ``expanded`` gives their tokens back."""

    def text(item: Column) -> Column:
        written = item
        for char, escaped in _ESCAPED:
            written = F.replace(written, F.lit(char), F.lit(escaped))
        return F.coalesce(F.when(item.rlike(f"[{_NEXT}-{_ESCAPE}]"), written).otherwise(item), F.lit(_NONE))

    run = F.col("_run")
    joined = [F.array_join(F.transform(run["items"][c], text), _NEXT).alias(c) for c in item_cols]
    return runs.withColumn("_run", F.struct(run["away"].alias("away"), run["number"].alias("number"), *joined))


def expanded(runs: Column, order_type: str, order_name: str, item_cols: list[str]) -> Column:
    """``ARRAY<STRUCT<order, items...>>`` of an array of packed runs."""

    def item(text: Column) -> Column:
        plain = text
        for char, escaped in _ESCAPED[::-1]:
            plain = F.replace(plain, F.lit(escaped), F.lit(char))
        return F.when(text == _NONE, None).when(F.contains(text, F.lit(_ESCAPE)), plain).otherwise(text)

    def split(run: Column) -> Column:
        # The items of a run are taken apart once, not for every token.
        items = [F.transform(F.split(run[c], _NEXT), item).alias(c) for c in item_cols]
        return F.struct(run["away"].alias("away"), run["number"].alias("number"), *items)

    def tokens(run: Column) -> Column:
        def token(number: Column, i: Column) -> Column:
            at = (F.get(run["away"], i) + i).cast(order_type).alias(order_name)
            return F.struct(at, *[F.get(run[c], number).alias(c) for c in item_cols])

        return F.transform(run["number"], token)

    return F.flatten(F.transform(F.transform(runs, split), tokens))
