"""Sharding by jump consistent hashing.

The shard of a key follows from the key's hash and the number of shards alone:
no ring table. When a shard is appended, a key either stays or moves to the new
shard, and just the fraction 1 / (shards + 1) moves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotonoha.plans.numbering import number_rows

# Fixed value: multiplier of the generator in the published jump hash.
_MULTIPLIER = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key."""
    key = keys.astype(np.uint64).copy()
    shard = np.zeros(len(key), np.int64)
    active = np.arange(len(key))
    jump = np.zeros(len(key), np.int64)
    while len(active):
        shard[active] = jump[active]
        key[active] = key[active] * _MULTIPLIER + np.uint64(1)
        scale = (key[active] >> np.uint64(33)).astype(np.float64) + 1.0
        jump[active] = ((shard[active] + 1) * (float(1 << 31) / scale)).astype(np.int64)
        active = active[jump[active] < shards]
    return shard.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """Jump-hash shard of any column; a missing key has the hash of a missing value."""

    @F.pandas_udf("int")
    def place(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashes.to_numpy(np.int64).view(np.uint64), shards))

    return place(F.xxhash64(key))


def assign_shards(
    docs: DataFrame, *, shards: int = 40, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``slot`` numbers the rows of a shard from 0 without gaps, in id order (ties:
    by checksum and size). ``grown_shard`` is the shard with one shard more. A
    repeated id has one shard and several slots; rows without an id share one
    shard, and a missing text has the 16 bytes of an empty one. Texts are read
    once and never shuffled; the numbering moves thin rows by range, so a shard
    of any size is numbered by many tasks.
    """
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    thin = docs.select(
        F.col(id_col),
        (F.octet_length(raw) + F.lit(16)).cast("long").alias("size"),
        F.crc32(raw).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(id_col), shards).alias("shard"),
        shard_of(F.col(id_col), shards + 1).alias("grown_shard"),
    )
    placed = number_rows(
        thin, [id_col, "text_crc32", "size"], group_cols=["shard"], output="slot", start=0
    )
    return placed.select(id_col, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
