"""Benchmark decontamination: containment search for short items in long documents.

Words are runs of ASCII letters, digits and non-ASCII characters with A-Z in
lower case; a text's shingles are its distinct runs of five words (fewer words:
the whole sequence). An item is found in a document that holds at least
``threshold`` of the item's shingles.

The containment form of MinHash sketches the small set and looks its minima up
in the large one. Items are partitioned by size into powers of two. All items of
a class get the same sketch length: the k smallest hashes of their shingles,
where k is one more than the largest item of the class may miss. A document that
holds enough of an item can then miss at most k - 1 of the minima, so the search
loses nothing. Each class has a table of its minima alone; a document's shingles
are looked up in these, and only items with enough minima there are candidates,
whose other shingles are then counted in the document, word by word.

The documents are never shuffled. Items travel as a broadcast of bounded size;
a larger benchmark is searched in blocks, one pass over the documents each.
"""

from __future__ import annotations

import math
import uuid
from fractions import Fraction
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.common import WORD_BYTES, column, mix, slices, utf8

SHINGLE = 5
THRESHOLD = 0.8
# Text of benchmark items that is broadcast at one time.
BLOCK_BYTES = 32 << 20
# Words of a document that are looked up at one time.
CHUNK_WORDS = 1 << 20

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63],
    np.uint64,
)


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(WORD_BYTES).split()


def allowed_misses(size: int, threshold: float) -> int:
    """Shingles that an item of ``size`` may lack and still be found."""
    return size - math.ceil(size * Fraction(str(threshold)))


def _windows(ids: np.ndarray) -> np.ndarray:
    """Rows of five word ids; a shorter text is one row padded with 0."""
    if len(ids) < SHINGLE:
        return np.pad(ids, (0, SHINGLE - len(ids)))[None, :] if len(ids) else np.zeros((0, SHINGLE), ids.dtype)
    return np.lib.stride_tricks.sliding_window_view(ids, SHINGLE)


def _codes(windows: np.ndarray, seed: int) -> np.ndarray:
    code = np.full(len(windows), seed, np.uint64)
    for k in range(SHINGLE):
        code = mix(code + windows[:, k].astype(np.uint64) * _FACTORS[k])
    return code


class SizeClass:
    """The minima of the items of one size class, and the items that each belongs to."""

    def __init__(self, members: list[tuple[int, np.ndarray]], needed: np.ndarray):
        codes = np.concatenate([c for _, c in members])
        owners = np.concatenate([np.full(len(c), item) for item, c in members])
        order = np.argsort(codes, kind="stable")
        self.codes, first = np.unique(codes[order], return_index=True)
        self.owners = owners[order]
        self.first = np.append(first, len(codes))
        self.needed = needed

    def candidates(self, present: np.ndarray, items: int) -> np.ndarray:
        """Items of the class with enough minima among a document's distinct codes."""
        at = np.searchsorted(self.codes, present)
        at[at == len(self.codes)] = 0
        at = at[self.codes[at] == present]
        if not len(at):
            return at
        sizes = self.first[at + 1] - self.first[at]
        spans = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.first[at], sizes)
        hits = np.bincount(self.owners[spans], minlength=items)
        return np.flatnonzero((hits >= self.needed) & (hits > 0))


class ItemIndex:
    """Items of a block by size class, looked up by a document's words.

    ``looked_up`` counts codes of documents looked up in a table of minima,
    ``verified`` shingles of candidates counted in a document.
    """

    def __init__(self, items: list[tuple], threshold: float):
        self.keys = [key for key, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.looked_up = self.verified = 0
        number = self.vocabulary.setdefault
        # Distinct shingles of each item as rows of word ids.
        self.shingles = []
        for _, text in items:
            ids = np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64)
            self.shingles.append(np.unique(_windows(ids), axis=0) if len(ids) else np.zeros((0, SHINGLE), np.int64))
        self.sizes = np.array([len(rows) for rows in self.shingles], np.int64)
        misses = np.array([allowed_misses(int(n), threshold) for n in self.sizes], np.int64)
        self.needed = self.sizes - misses
        # An item's codes are distinct, so that a minimum stands for one shingle of it.
        seed = 1
        while True:
            coded = [np.sort(_codes(rows, seed)) for rows in self.shingles]
            if all((np.diff(c) != 0).all() for c in coded):
                break
            seed += 1
        self.seed = seed
        by_class: dict[int, list] = {}
        self.sketch_needed = np.zeros(len(items), np.int64)
        for item, n in enumerate(self.sizes.tolist()):
            if n:
                largest = (1 << n.bit_length()) - 1
                k = min(n, allowed_misses(largest, threshold) + 1)
                self.sketch_needed[item] = k - misses[item]
                by_class.setdefault(n.bit_length(), []).append((item, coded[item][:k]))
        self.classes = [SizeClass(members, self.sketch_needed) for _, members in sorted(by_class.items())]

    def _chunks(self, words: list[bytes]):
        """Windows of a document whose words all stand in items, with their codes, piece by piece."""
        for start in range(0, max(1, len(words)), CHUNK_WORDS):
            some = words[start : start + CHUNK_WORDS + SHINGLE - 1]
            if start and len(some) < SHINGLE:
                return
            ids = np.fromiter(map(self.vocabulary.get, some, repeat(-1)), np.int64, len(some))
            windows = _windows(ids)
            full = windows[(windows >= 0).all(axis=1)]  # -1: a word of no item
            yield full, _codes(full, self.seed)

    def search(self, words: list[bytes]) -> list[tuple]:
        """(key, size, found) of the items that the words hold."""
        chunks = list(self._chunks(words))
        present = np.unique(np.concatenate([codes for _, codes in chunks]))
        if not len(present):
            return []
        self.looked_up += len(present) * len(self.classes)
        found = []
        for one in self.classes:
            for item in one.candidates(present, len(self.keys)).tolist():
                n = self._count(item, chunks)
                if n >= self.needed[item]:
                    found.append((self.keys[item], int(self.sizes[item]), n))
        return found

    def _count(self, item: int, chunks: list[tuple]) -> int:
        """Shingles of an item that stand in the document, compared word by word."""
        wanted = self.shingles[item]
        self.verified += len(wanted)
        codes = _codes(wanted, self.seed)
        order = np.argsort(codes)
        have = np.zeros(len(wanted), bool)
        for windows, held in chunks:
            at = np.searchsorted(codes[order], held)
            at[at == len(codes)] = 0
            hit = np.flatnonzero(codes[order][at] == held)
            rows = order[at[hit]]
            have[rows[(wanted[rows] == windows[hit]).all(axis=1)]] = True
        return int(have.sum())


# The index of a worker's last block: building it for every task would repeat the work.
_INDEXES: dict[tuple, ItemIndex] = {}


def _index(name: str, block, threshold: float) -> ItemIndex:
    """Index of a block, told apart by a name that no other block ever has."""
    if (name, threshold) not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name, threshold] = ItemIndex(block.value, threshold)
    return _INDEXES[name, threshold]


def _blocks(items: DataFrame, item_col: str, text_col: str):
    """Lists of (key, text) of bounded size; the items are read one partition at a time."""
    block, size = [], 0
    rows = items.select(item_col, F.col(text_col).cast("string").alias("_t")).where("_t IS NOT NULL")
    for key, text in rows.toLocalIterator():
        if size + len(text) > BLOCK_BYTES and block:
            yield block
            block, size = [], 0
        block.append((key, text))
        size += 4 + len(text.encode("utf-8", "surrogatepass"))
    if block:
        yield block


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc id, item id, n_shingles, n_found, containment) of every item found in a document.

    A row per document row and item row; missing ids are kept as they are.
    Missing texts and texts without words hold nothing and are found nowhere. An
    item of fewer than five words is found only in a document of just these
    words. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    doc_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_col].dataType.simpleString()
    item_name = item_col if item_col != id_col else f"{item_col}_item"
    schema = f"_doc {doc_type}, _item {item_type}, n_shingles long, n_found long, containment double"
    source = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).cast("string").alias("_text"))

    def searched(block):
        name = uuid.uuid4().hex

        def run(batches):
            index = _index(name, block, threshold)
            for batch in slices(batches):
                rows, keys, sizes, counts = [], [], [], []
                for row, text in enumerate(column(batch, "_text")):
                    for key, n, found in index.search(words_of(text)):
                        rows.append(row)
                        keys.append(key)
                        sizes.append(n)
                        counts.append(found)
                n = pa.array(sizes, pa.int64())
                share = np.asarray(counts, float) / np.asarray(sizes, float)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_doc": batch.column(0).take(pa.array(rows, pa.int64())),
                        "_item": keys if keys else pa.array([], pa.null()),
                        "n_shingles": n,
                        "n_found": pa.array(counts, pa.int64()),
                        "containment": pa.array(share, pa.float64()),
                    },
                    schema=pa.schema(
                        [
                            ("_doc", batch.schema.field(0).type), ("_item", _ARROW.get(item_type, pa.string())),
                            ("n_shingles", pa.int64()), ("n_found", pa.int64()), ("containment", pa.float64()),
                        ]
                    ),
                )

        return source.mapInArrow(run, schema)

    parts = [searched(spark.sparkContext.broadcast(block)) for block in _blocks(items, item_col, item_text_col)]
    found = spark.createDataFrame([], schema) if not parts else parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.withColumnRenamed("_doc", id_col).withColumnRenamed("_item", item_name)


def drop_holders(
    docs: DataFrame,
    items: DataFrame,
    *,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows whose text holds no item, all columns untouched, in one pass per block of items.

    Missing texts hold nothing; every row is judged by itself, with or without an id.
    """
    spark = docs.sparkSession

    def without(rest: DataFrame, block) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches):
            index = _index(name, block, threshold)
            for batch in slices(batches):
                keep = [not index.search(words_of(text)) for text in column(batch, text_col)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return rest.mapInArrow(run, docs.schema)

    for block in _blocks(items, item_col, item_text_col):
        docs = without(docs, spark.sparkContext.broadcast(block))
    return docs


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
