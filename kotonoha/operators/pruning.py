"""Leaving out keys that cannot reach a minimum count, before they are shuffled.

Most distinct n-grams of a corpus occur once. A first pass counts rows per hash
bucket of the key: every task keeps one small saturating counter per bucket and
sends its counters as a few binary rows. Buckets whose rows together stay below
``min_count`` cannot hold a key that reaches it; a bitmap of the others is sent
to all tasks, and only keys in those buckets are counted exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotonoha.plans.layout import cut_lineage

# Buckets whose counters one row carries.
SLICE = 1 << 18
# The bitmap that is sent to all tasks has this many bits at most.
MAX_BUCKETS = 1 << 26


def _counters(min_count: int) -> np.dtype:
    return np.min_scalar_type(2 * min_count)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def open_buckets(rows: DataFrame, key_col: str, min_count: int, buckets: int) -> DataFrame:
    """``[word, bits]``: 64 buckets each, bit set where a bucket's rows reach ``min_count``."""
    kind = _counters(min_count)

    def count(batches):
        held = np.zeros(buckets, kind)
        for batch in batches:
            found, n = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            held[found] = np.minimum(held[found].astype(np.int64) + n, min_count).astype(kind)
        for start in range(0, buckets, SLICE):
            part = held[start : start + SLICE]
            if part.any():
                packed = pa.compress(part.tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start // SLICE], pa.int32()), pa.array([packed], pa.binary())], names=["slice", "held"]
                )

    def words(number: int, total: np.ndarray) -> pa.RecordBatch:
        bits = np.packbits(total >= min_count, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % 8)).view("<i8")
        some = np.flatnonzero(bits)
        return pa.RecordBatch.from_arrays(
            [pa.array(some + number * (SLICE // 64)), pa.array(bits[some].astype(np.int64))], names=["word", "bits"]
        )

    def merge(batches):
        # Rows of a slice stand together; one slice is in memory at a time.
        number, total = None, None
        for batch in batches:
            for i, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i != number:
                    if number is not None:
                        yield words(number, total)
                    number, total = i, 0
                size = min(SLICE, buckets - i * SLICE)
                part = np.frombuffer(pa.decompress(held, size * kind.itemsize, "zstd", asbytes=True), kind)
                total = np.minimum(total + part.astype(np.int64), min_count)
        if number is not None:
            yield words(number, total)

    hashes = rows.where(F.col(key_col).isNotNull()).select(_bucket(F.col(key_col), buckets).alias("bucket"))
    partial = hashes.mapInArrow(count, "slice int, held binary")
    dealt = partial.repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(merge, "word long, bits long")


def prune_rare(rows: DataFrame, key_col: str, min_count: int, buckets: int) -> DataFrame:
    """Rows whose key may still occur ``min_count`` times; no frequent key is lost.

    More buckets keep fewer rare keys; about four per row leave few. ``rows`` is
    read twice. Rows without a key go.
    """
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"from 1 to {MAX_BUCKETS} buckets")
    if min_count <= 1:
        return rows
    # One row per 64 buckets at most, bounded by MAX_BUCKETS.
    bitmap = cut_lineage(open_buckets(rows, key_col, min_count, buckets))
    bucket = _bucket(F.col(key_col), buckets)
    numbered = rows.withColumn("_bucket", bucket)
    word = F.shiftright("_bucket", 6)
    bitmap = bitmap.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    joined = numbered.join(F.broadcast(bitmap), word == F.col("_word"))
    inside = F.getbit(F.col("_bits"), F.col("_bucket").bitwiseAND(F.lit(63)).cast("int")) == 1
    return joined.where(inside).select(*rows.columns)
