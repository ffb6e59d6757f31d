"""Topics by online variational Bayes, with the words' weights in blocks on shared storage.

The updates and defaults are those of MLlib's online LDA, which keeps several matrices
of topics by words on the driver and sums them there. Here a task sums what it met of
each block of words, blocks are updated where their rows meet, and the driver holds a
few numbers per topic. A worker reads one matrix of topics by words, once per pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kotonoha.plans.layout import fix_wide, remove_folder, wide_folder
from kotonoha.sources.files import arrow_place, arrow_reads

# Fixed values of MLlib: share of the documents in a pass, slowing of the steps, shape of the
# first draws, and the mean change at which a document's topics stand still.
FRACTION, TAU, KAPPA, SHAPE, STILL = 0.05, 1024.0, 0.51, 100.0, 1e-3
# Words of a block, and cells of documents whose topics are found together.
BLOCK_WORDS = 1 << 16
CELLS_AT_ONCE = 1 << 18

# Of the words of a block, in order: their weights by topic, and exp(digamma) of these.
_MODEL = "block int, weights array<double>, powers array<double>"
# What a task met: words of a block, in order, with sums by topic; block -1 has the sums over documents.
_PARTS = "block int, words array<int>, sums array<double>, documents long"


def _digamma(x: np.ndarray) -> np.ndarray:
    x, found = np.array(x, np.float64), np.zeros(np.shape(x))
    for _ in range(6):
        small = x < 6
        found -= np.divide(1.0, x, out=np.zeros_like(x), where=small)
        x = x + small
    f = 1 / (x * x)
    return found + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def _trigamma(x: np.ndarray) -> np.ndarray:
    x, found = np.array(x, np.float64), np.zeros(np.shape(x))
    for _ in range(6):
        small = x < 6
        found += np.divide(1.0, x * x, out=np.zeros_like(x), where=small)
        x = x + small
    f = 1 / (x * x)
    return found + 1 / x + f / 2 + f / x * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30)))


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of every cell, word, count) of stored ML vectors, rows in order; zeros left out."""
    kind = column.field("type").to_numpy(zero_copy_only=False)
    values, indices = column.field("values"), column.field("indices")
    known = column.is_valid().to_numpy(zero_copy_only=False)
    if known.all() and (kind == 0).all():
        lengths = values.value_lengths().to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(column)), lengths)
        words, counts = indices.flatten().to_numpy(), values.flatten().to_numpy()
    else:
        found = [([], []) if v is None else (v["indices"] if v["type"] == 0 else range(len(v["values"])), v["values"]) for v in column.to_pylist()]
        rows = np.repeat(np.arange(len(found)), [len(v) for _, v in found])
        words = np.array([w for some, _ in found for w in some], np.int64)
        counts = np.array([c for _, some in found for c in some], np.float64)
    some = counts != 0
    return rows[some], words[some], counts[some]


def _pieces(rows: np.ndarray) -> Iterator[slice]:
    """Slices of whole documents with about ``CELLS_AT_ONCE`` cells."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    begin = 0
    while begin < len(rows):
        after = np.searchsorted(starts, begin + CELLS_AT_ONCE, side="right")
        # The last document that ends within reach, or one that is longer alone.
        end = len(rows) if begin + CELLS_AT_ONCE >= len(rows) else int(starts[after - 1])
        if end <= begin:
            end = int(starts[after]) if after < len(starts) else len(rows)
        yield slice(begin, end)
        begin = end


def _inferred(rows, words, counts, powers, alpha, seed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents with cells: their numbers, their topics, and what each cell adds to its word's sums."""
    documents, starts = np.unique(rows, return_index=True)
    k, n = len(alpha), len(documents)
    # Topics lead, so that every step runs along the cells; those of a document stand together.
    start, sizes = starts, np.diff(np.append(starts, len(rows)))
    b, c, held = np.ascontiguousarray(powers[words].T), counts, np.arange(len(rows))
    gamma = np.tile(np.random.default_rng(seed).gamma(SHAPE, 1 / SHAPE, k), (n, 1))
    adds = np.empty((len(rows), k))

    def seen(g):
        """exp(E[log theta]) of documents, at their cells too, and the sums over topics there."""
        t = np.exp(_digamma(g) - _digamma(g.sum(axis=1))[:, None])
        at = np.repeat(t.T, sizes, axis=1)
        return t, at, (b * at).sum(axis=0) + 1e-100

    # Documents whose topics still move, and their cells.
    moving = np.arange(n)
    t, at, phi = seen(gamma)
    while len(moving):
        last = gamma[moving]
        new = t * np.add.reduceat(b * (c / phi), start, axis=1).T + alpha
        gamma[moving] = new
        t, at, phi = seen(new)
        still = np.abs(new - last).mean(axis=1) <= STILL
        if still.any():
            left = ~np.repeat(still, sizes)
            adds[held[~left]] = (at * (c / phi))[:, ~left].T
            moving, t, sizes = moving[~still], t[~still], sizes[~still]
            b, c, held, phi = b[:, left], c[left], held[left], phi[left]
            start = np.cumsum(sizes) - sizes
    return documents, gamma, adds


_READ: dict[str, np.ndarray] = {}


@dataclass
class _Model:
    """Blocks of words at ``path``, and the numbers by topic that turn powers into exp(E[log beta])."""

    path: str
    size: int
    factors: np.ndarray
    blocks: object = None  # broadcast of the powers, where the workers cannot read the path

    def powers(self) -> np.ndarray:
        if self.path not in _READ:
            _READ.clear()  # of the pass before
            if self.blocks is None:
                system, place = arrow_place(self.path)
                table = pq.read_table(place, filesystem=system, columns=["block", "powers"])
            else:
                table = self.blocks.value
            found = np.zeros((self.size, len(self.factors)))
            for block, some in zip(table["block"].to_pylist(), table["powers"], strict=True):
                begin = block * BLOCK_WORDS
                found[begin : begin + BLOCK_WORDS] = some.values.to_numpy().reshape(-1, len(self.factors))
            _READ[self.path] = found * self.factors
        return _READ[self.path]


def _kept(blocks: DataFrame, size: int, topics: int) -> _Model:
    """Blocks ``[block, weights, powers]`` fixed, and their sums by topic."""
    path = wide_folder(blocks.sparkSession)
    table = fix_wide(blocks, path=path)
    totals = np.zeros(topics)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batch.column(0):
                total = some.values.to_numpy().reshape(-1, topics).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])

    # One row per block of words.
    for row in table.select("weights").mapInArrow(summed, "total array<double>").toLocalIterator():
        totals += row["total"]
    held = None
    if not arrow_reads(path):
        held = blocks.sparkSession.sparkContext.broadcast(table.select("block", "powers").toArrow())
    return _Model(path, size, np.exp(-_digamma(totals)) if size else np.ones(topics), held)


def _block(block: int, weights: np.ndarray) -> pa.Table:
    flat = pa.list_(pa.float64())
    columns = [pa.array([w.ravel()], flat) for w in (weights, np.exp(_digamma(weights)))]
    return pa.table([pa.array([block], pa.int32()), *columns], names=["block", "weights", "powers"])


def _first_blocks(spark: SparkSession, size: int, topics: int, seed: int) -> DataFrame:
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                words = min(BLOCK_WORDS, size - block * BLOCK_WORDS)
                rng = np.random.default_rng([seed, block])
                yield from _block(block, rng.gamma(SHAPE, 1 / SHAPE, (words, topics))).to_batches()

    return spark.range(-(-size // BLOCK_WORDS)).mapInArrow(draw, _MODEL)


def _met(batch: DataFrame, counts_col: str, model: _Model, alpha: np.ndarray, seed: int) -> DataFrame:
    """Rows of ``_PARTS`` of the documents of a pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, sums, logs, documents = len(alpha), None, np.zeros(len(alpha)), 0
        for some in batches:
            rows, words, counts = _cells(some.column(0))
            for piece in _pieces(rows):
                found, gamma, adds = _inferred(rows[piece], words[piece], counts[piece], model.powers(), alpha, seed)
                sums = np.zeros((model.size, k)) if sums is None else sums
                order = np.argsort(words[piece], kind="stable")
                sorted_words = words[piece][order]
                starts = np.flatnonzero(np.diff(sorted_words, prepend=-1))
                sums[sorted_words[starts]] += np.add.reduceat(adds[order], starts, axis=0)
                logs += (_digamma(gamma) - _digamma(gamma.sum(axis=1))[:, None]).sum(axis=0)
                documents += len(found)
        if not documents:
            return
        used = np.flatnonzero(sums.any(axis=1))
        groups = np.split(used, np.flatnonzero(np.diff(used // BLOCK_WORDS)) + 1)
        kinds = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int64()]
        lines = [[int(g[0] // BLOCK_WORDS), g.astype(np.int32), sums[g].ravel(), 0] for g in groups if len(g)]
        for line in [[-1, np.zeros(0, np.int32), logs, documents], *lines]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(line, kinds, strict=True)],
                names=["block", "words", "sums", "documents"],
            )

    return batch.select(counts_col).mapInArrow(run, _PARTS)


def _updated(table: DataFrame, parts: DataFrame, model: _Model, rate: float, scale: float, eta: float) -> DataFrame:
    factors = model.factors

    def update(rows: pa.Table) -> pa.Table:
        block = rows["block"][0].as_py()
        old = rows.filter(rows["weights"].is_valid())
        weights = old["weights"][0].values.to_numpy().reshape(-1, len(factors))
        beta = old["powers"][0].values.to_numpy().reshape(weights.shape) * factors
        sums = np.zeros_like(weights)
        for words, some in zip(rows["words"], rows["sums"], strict=True):
            if words.is_valid:
                sums[words.values.to_numpy() - block * BLOCK_WORDS] += some.values.to_numpy().reshape(-1, len(factors))
        return _block(block, (1 - rate) * weights + rate * (sums * beta * scale + eta))

    update.__annotations__ = {"rows": pa.Table, "return": pa.Table}
    both = table.unionByName(parts.where("block >= 0").select("block", "words", "sums"), allowMissingColumns=True)
    return both.groupBy("block").applyInArrow(update, _MODEL)


def _moved_alpha(alpha: np.ndarray, logs: np.ndarray, documents: int, rate: float) -> np.ndarray:
    """One Newton step of the documents' prior, as MLlib makes it."""
    slope = documents * (_digamma(alpha.sum()) - _digamma(alpha) + logs / documents)
    c, q = documents * _trigamma(alpha.sum()), -documents * _trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - rate * (slope - b) / q
    return moved if (moved > 0).all() else alpha


@dataclass
class TopicModel:
    """Trained topics; ``transform`` adds the ``topicDistribution`` of every document."""

    model: _Model
    alpha: np.ndarray
    seed: int
    counts_col: str

    def transform(self, vectors: DataFrame) -> DataFrame:
        """Shares of the topics as ML vectors; zeros for a document without a word."""
        model, alpha, seed, place = self.model, self.alpha, self.seed, vectors.columns.index(self.counts_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, words, counts = _cells(batch.column(place))
                shares = np.zeros((batch.num_rows, len(alpha)))
                for piece in _pieces(rows):
                    found, gamma, _ = _inferred(rows[piece], words[piece], counts[piece], model.powers(), alpha, seed)
                    shares[found] = gamma / gamma.sum(axis=1, keepdims=True)
                n = batch.num_rows
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * len(alpha))
                dense = pa.StructArray.from_arrays(
                    [pa.array(np.ones(n, np.int8)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(shares.ravel()))],
                    names=["type", "size", "indices", "values"],
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, dense], names=[*batch.schema.names, "topicDistribution"])

        schema = T.StructType([*vectors.schema.fields, T.StructField("topicDistribution", VectorUDT())])
        return vectors.mapInArrow(run, schema)


def train(vectors: DataFrame, *, topics: int, epochs: int, seed: int, counts_col: str) -> TopicModel:
    """``epochs`` passes, each over a draw of the documents with as many updates of all words' weights."""
    spark = vectors.sparkSession
    first = vectors.select(counts_col).first()
    if first is None:
        raise ValueError("no document to train topics on")
    size, corpus, eta = first[0].size, vectors.count(), 1.0 / topics
    alpha = np.full(topics, 1.0 / topics)
    model = _kept(_first_blocks(spark, size, topics, seed), size, topics)
    seeds = np.random.default_rng(seed).integers(1 << 31, size=epochs).tolist()
    done = 0
    for draw in seeds:
        batch = vectors.select(counts_col).sample(True, FRACTION, draw).coalesce(spark.sparkContext.defaultParallelism)
        folder = wide_folder(spark)
        parts = fix_wide(_met(batch, counts_col, model, alpha, seed), path=folder)
        # One row of every task.
        over = parts.where("block = -1").select("sums", "documents").collect()
        documents = sum(r["documents"] for r in over)
        if documents:
            done += 1
            rate = (TAU + done) ** -KAPPA
            table = spark.read.schema(_MODEL).parquet(model.path)
            scale = corpus / math.ceil(FRACTION * corpus)
            old, model = model, _kept(_updated(table, parts, model, rate, scale, eta), size, topics)
            remove_folder(spark, old.path)
            alpha = _moved_alpha(alpha, np.sum([r["sums"] for r in over], axis=0), documents, rate)
        remove_folder(spark, folder)
    return TopicModel(model, alpha, seed, counts_col)
