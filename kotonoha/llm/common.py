"""Helpers shared by the operators: reading, batching, folds and byte-level words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kotonoha.plans.layout import cut_lineage

# Rows and characters that are Python objects at one time inside a task.
SLICE_ROWS = 256
# Classes of a draw whose rates are sent to all tasks.
BROADCAST_CLASSES = 100_000

# Byte tables. Words of `[^\x20\x09-\x0D]+` are what bytes.split() gives; words of
# `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` are what it gives after WORD_BYTES.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD_BYTES = bytes(
    LOWER_BYTES[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def arrow_schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in types.items()])


def scored_texts(
    docs: DataFrame,
    build: Callable[[], Callable[[list], dict]],
    outputs: str,
    arrow: dict[str, pa.DataType],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, outputs) for every row, one pass, no shuffle.

    ``build`` runs once per task and returns a function from a list of texts
    (None for a missing one) to the output columns. Only the id and the text
    are read, so other columns of any name do not matter.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        score = None
        for batch in slices(batches):
            score = score or build()
            found = score(column(batch, "_text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(found[n], t) for n, t in arrow.items()]],
                names=["_id", *arrow],
            )

    return source.mapInArrow(run, f"_id {id_type}, {outputs}").withColumnRenamed("_id", id_col)


def free_names(taken, *names: str) -> list[str]:
    """The names, each with underscores before it until no column has it."""
    found = []
    for name in names:
        while name in taken or name in found:
            name = "_" + name
        found.append(name)
    return found


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3 style) on unsigned words."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def drawn_rows(rows: DataFrame, class_col: str, draw_col: str, per_class: int) -> DataFrame:
    """A repeatable draw of about ``per_class`` distinct draw values of each class.

    A class's rate follows from a sketch of its distinct values, so no class is
    gathered or ranked; values are hashes, and equal rows are drawn or left
    together. All classes take part; their rates are sent to all tasks while
    they are few, and joined beyond.
    """
    counts = rows.groupBy(class_col).agg(F.approx_count_distinct(draw_col).alias("_n"))
    rates = cut_lineage(
        counts.select(class_col, (F.lit(float(per_class)) / F.greatest(F.col("_n"), F.lit(1))).alias("_rate"))
    )
    few = rates.limit(BROADCAST_CLASSES + 1).count() <= BROADCAST_CLASSES
    share = F.pmod(F.col(draw_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    joined = rows.join(F.broadcast(rates) if few else rates, class_col)
    return joined.where(share < F.col("_rate")).drop("_rate")
