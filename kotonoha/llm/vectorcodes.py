"""Compression of vectors to product codes by dual-tree Lloyd rounds in exact integers.

A vector is cut into equal parts; each part position has a codebook, and a
vector's code is the number of the nearest entry for each of its parts. Lloyd
rounds assign all parts and replace every entry by the floored mean of its parts.

Parts and entries both stand in trees of boxes. Pairs of nodes, one of either
tree, are followed downwards together. For a node of parts the smallest of the
farthest distances to an entry node bounds what any of its parts can need; entry
nodes that are nearer to none of them are dropped. Where one entry is left, the
whole node goes to it, with its cached sum; where several are left at a leaf,
the distances are computed, in integers, and equal ones go to the lower number.

Spark holds the vectors in blocks, in the order of their trees, written once.
A round is one pass over the blocks: a task adds up sums and counts per entry,
Spark adds up the tasks, and the new entries, whose number is fixed, go back
with the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kotonoha.llm.common import arrow_schema
from kotonoha.plans.layout import cut_lineage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Vectors of a block and parts of a leaf of its trees.
BLOCK_ROWS = 8192
LEAF_PARTS = 64
# Integer components stay below this size, so that no distance leaves 64 bits.
LARGEST = 1 << 24
# Sums of products below this are exact in floating point.
EXACT = 1 << 53


@dataclass
class Tree:
    """Nodes as ranges of a reordered array, level by level, with their boxes.

    ``bounds[l]`` are the borders of level l's ranges, ``first[l]`` the number of
    the first child of each of its nodes on the next level. A range that is not
    split goes on as its only child.
    """

    points: np.ndarray
    order: np.ndarray
    bounds: list[np.ndarray]
    first: list[np.ndarray] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        """Children and boxes; a box is put together from those of the children."""
        for level, below in zip(self.bounds, self.bounds[1:], strict=False):
            self.first.append(np.searchsorted(below, level))
        starts = self.bounds[-1][:-1]
        low, high = (f.reduceat(self.points, starts) for f in (np.minimum, np.maximum))
        self.low, self.high = [low], [high]
        for first in reversed(self.first):
            low, high = np.minimum.reduceat(low, first[:-1]), np.maximum.reduceat(high, first[:-1])
            self.low.insert(0, low)
            self.high.insert(0, high)

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``nodes``, child) for all children on the next level."""
        first = self.first[level]
        sizes = first[nodes + 1] - first[nodes]
        rows = np.repeat(np.arange(len(nodes)), sizes)
        return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[nodes][rows]


def level_bounds(n: int, leaf: int) -> list[np.ndarray]:
    """Borders of the ranges of every level, halved until none is above ``leaf``."""
    bounds = [np.array([0, n])]
    while (sizes := np.diff(bounds[-1])).max() > leaf:
        middles = bounds[-1][:-1] + sizes // 2
        bounds.append(np.unique(np.concatenate([bounds[-1], middles[sizes > leaf]])))
    return bounds


def grow_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the points in which every range of the tree is split at its widest side's median."""
    order = np.arange(len(points))
    for bounds in level_bounds(len(points), leaf)[:-1]:
        for start, stop in zip(bounds, bounds[1:], strict=False):
            if stop - start > leaf:
                some = points[order[start:stop]]
                widest = np.argmax(some.max(0) - some.min(0)) if some.shape[1] else 0
                if some.shape[1]:
                    split = np.argpartition(some[:, widest], (stop - start) // 2, kind="introselect")
                    order[start:stop] = order[start:stop][split]
    return order


def grow(points: np.ndarray, leaf: int) -> Tree:
    order = grow_order(points, leaf)
    return Tree(points[order], order, level_bounds(len(points), leaf))


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the nearest entry, squared distance) of each point, in exact integers."""
    reach = int(np.abs(points).max(initial=0)) * int(np.abs(entries).max(initial=0)) * max(1, points.shape[1])
    if reach < EXACT:
        products = (points.astype(np.float64) @ entries.T.astype(np.float64)).astype(np.int64)
    else:
        products = points @ entries.T
    distances = (entries**2).sum(1) - 2 * products
    best = distances.argmin(1)
    return best, (points**2).sum(1) + distances[np.arange(len(points)), best]


def assign(parts: Tree, entries: Tree, count: list[int] | None = None) -> Iterator[tuple]:
    """(start, stop, entry) of whole nodes and (start, stop, candidates) of uncertain leaves.

    Candidates are entry numbers in order. ``count`` gets the number of distances
    between a part and an entry that the leaves will need.
    """
    a = b = np.zeros(1, np.int64)
    level_a = level_b = 0
    last_a, last_b = len(parts.bounds) - 1, len(entries.bounds) - 1
    while True:
        lo, hi = parts.low[level_a][a], parts.high[level_a][a]
        e_lo, e_hi = entries.low[level_b][b], entries.high[level_b][b]
        gap = np.maximum(np.maximum(lo - e_hi, e_lo - hi), 0)
        span = np.maximum(hi - e_lo, e_hi - lo)
        near, far = (gap**2).sum(1), (span**2).sum(1)
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        keep = near <= np.repeat(np.minimum.reduceat(far, starts), np.diff(starts, append=len(a)))
        a, b = a[keep], b[keep]
        # A node with one single entry left is done, on whatever level it is.
        starts = np.flatnonzero(np.diff(a, prepend=-1))
        sizes = np.diff(starts, append=len(a))
        single = entries.bounds[level_b][b[starts] + 1] - entries.bounds[level_b][b[starts]] == 1
        done = (sizes == 1) & single
        borders = parts.bounds[level_a]
        for node, entry in zip(a[starts[done]].tolist(), b[starts[done]].tolist(), strict=True):
            yield borders[node], borders[node + 1], int(entries.order[entries.bounds[level_b][entry]])
        if level_a == last_a and level_b == last_b:
            for at, size in zip(starts[~done].tolist(), sizes[~done].tolist(), strict=True):
                start, stop = borders[a[at]], borders[a[at] + 1]
                candidates = np.sort(entries.order[entries.bounds[level_b][b[at : at + size]]])
                if count is not None:
                    count[0] += int(stop - start) * size
                yield start, stop, candidates
            return
        rest = np.repeat(~done, sizes)
        a, b = a[rest], b[rest]
        if not len(a):
            return
        if level_b < last_b:
            rows, b = entries.children(level_b, b)
            a, level_b = a[rows], level_b + 1
        if level_a < last_a:
            rows, children = parts.children(level_a, a)
            order = np.argsort(children, kind="stable")
            a, b, level_a = children[order], b[rows][order], level_a + 1


def entry_tree(entries: np.ndarray) -> Tree:
    return grow(entries, 1)


class Sums:
    """Sums and counts per part position and entry."""

    def __init__(self, codebooks: list[np.ndarray]):
        self.codebooks = codebooks
        self.trees = [entry_tree(c) for c in codebooks]
        self.sums = [np.zeros(c.shape, np.int64) for c in codebooks]
        self.counts = [np.zeros(len(c), np.int64) for c in codebooks]

    def add(self, position: int, tree: Tree) -> None:
        sums, counts = self.sums[position], self.counts[position]
        before = np.zeros((len(tree.points) + 1, tree.points.shape[1]), np.int64)
        np.cumsum(tree.points, axis=0, out=before[1:])
        codes, rows = [], []
        for start, stop, found in assign(tree, self.trees[position]):
            if isinstance(found, int):
                sums[found] += before[stop] - before[start]
                counts[found] += stop - start
            else:
                best, _ = nearest(tree.points[start:stop], self.codebooks[position][found])
                codes.append(found[best])
                rows.append(np.arange(start, stop))
        if codes:
            codes, rows = np.concatenate(codes), np.concatenate(rows)
            order = np.argsort(codes, kind="stable")
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            present = codes[order][starts]
            sums[present] += np.add.reduceat(tree.points[rows[order]], starts)
            counts[present] += np.diff(starts, append=len(codes))


def coded(tree: Tree, entries: np.ndarray, entries_tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of each part in the tree's original order."""
    codes = np.empty(len(tree.points), np.int64)
    for start, stop, found in assign(tree, entries_tree):
        if not isinstance(found, int):
            found = found[nearest(tree.points[start:stop], entries[found])[0]]
        codes[start:stop] = found
    errors = ((tree.points - entries[codes]) ** 2).sum(1)
    back = np.empty(len(codes), np.int64)
    back[tree.order] = np.arange(len(codes))
    return codes[back], errors[back]


def usable(vector: Column) -> Column:
    """No missing vector and no missing or non-finite component."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def _unpack(held: bytes, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(held, "<i4").reshape(shape)


def _trees(row: dict, parts: int) -> Iterator[Tree]:
    """The trees of a block, one per part position."""
    n = row["n"]
    bounds = level_bounds(n, LEAF_PARTS)
    at = 0
    orders = _unpack(row["orders"], (parts, n))
    flat = _unpack(row["points"], (-1,))
    for position, width in enumerate(row["widths"]):
        points = flat[at : at + n * width].reshape(n, width).astype(np.int64)
        at += n * width
        yield Tree(points, orders[position], bounds)


def _blocks(kept: DataFrame, parts: int, width: int) -> DataFrame:
    """Rows of up to BLOCK_ROWS vectors: their carried columns, parts in tree order, orders."""
    carried = kept.schema["_carried"].dataType.simpleString()
    widths = [len(x) for x in np.array_split(np.arange(width), parts)]
    cuts = np.cumsum(widths)[:-1]

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                n = batch.num_rows
                values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, width)
                points, orders = [], []
                for part in np.split(values, cuts, axis=1):
                    order = grow_order(part, LEAF_PARTS)
                    points.append(part[order].astype("<i4").tobytes())
                    orders.append(order.astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0)),
                        pa.array([n], pa.int32()),
                        pa.array([widths], pa.list_(pa.int32())),
                        pa.array([b"".join(points)], pa.binary()),
                        pa.array([b"".join(orders)], pa.binary()),
                    ],
                    names=["carried", "n", "widths", "points", "orders"],
                )

    return kept.mapInArrow(
        run, f"carried array<{carried}>, n int, widths array<int>, points binary, orders binary"
    )


def _rows(batches) -> Iterator[tuple[dict, pa.Array]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n != "carried"}
            yield row, batch.column(0).slice(i, 1).flatten()


def next_codebooks(blocks: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One round: floored means of the parts of each entry; unused entries stay."""
    schema = arrow_schema(part=pa.int32(), entry=pa.int32(), place=pa.int32(), total=pa.int64(), n=pa.int64())

    def run(batches):
        found = None
        for row, _ in _rows(batches):
            found = found or Sums(codebooks)
            for position, tree in enumerate(_trees(row, len(codebooks))):
                found.add(position, tree)
        if found is None:
            return
        for position, (sums, counts) in enumerate(zip(found.sums, found.counts, strict=True)):
            used = np.flatnonzero(counts)
            width = sums.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used) * width, position), pa.int32()),
                    pa.array(np.repeat(used, width), pa.int32()),
                    pa.array(np.tile(np.arange(width), len(used)), pa.int32()),
                    pa.array(sums[used].ravel()),
                    pa.array(np.repeat(counts[used], width)),
                ],
                schema=schema,
            )

    partial = blocks.select("carried", "n", "widths", "points", "orders").mapInArrow(
        run, "part int, entry int, place int, total long, n long"
    )
    # Sums over any number of rows stay exact in decimals.
    totals = partial.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(28,0)")).alias("total"), F.sum("n").alias("n")
    )
    following = [c.copy() for c in codebooks]
    for r in totals.toLocalIterator():  # as many rows as the codebooks have components
        following[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return following


@dataclass
class VectorCodes:
    """``rows``: the vectors' carried columns with ``code`` and ``error``; the final entries."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components as decimals, by part, entry and place."""
        flat = [str(x) for c in self.codebooks for x in c.ravel().tolist()]
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    carry: Sequence[str] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> VectorCodes:
    """Product codes of all vectors and the codebooks they were made with.

    Vectors that are missing or hold a missing or non-finite component are left
    out. Components become floor(scale * x). The codebooks start as the parts of
    the first ``entries`` vectors by id (equal ids by vector, missing ids last; all
    of them where there are fewer) and have ``rounds`` rounds. ``rows`` has one row
    per vector kept: the id, the ``carry`` columns, ``code`` (two hex digits per
    part) and ``error``, the squared distances summed over parts. A vector of
    another length than the first one's, or with a component of 2^24 or more after
    scaling, keeps its row, with neither code nor error, and moves no entry. Equal
    vectors have equal codes. Other columns are not read. An empty table has no
    rows and no entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    spark = vectors.sparkSession
    names = [id_col, *carry]
    numbers = F.transform(F.col(vector_col), lambda x: F.floor(x.cast(DoubleType()) * float(scale)))
    small = F.forall(F.col(vector_col), lambda x: F.abs(x.cast(DoubleType()) * float(scale)) < float(LARGEST))
    kept = vectors.where(usable(F.col(vector_col))).select(
        F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)]).alias("_carried"),
        F.when(small, numbers).alias("_v"),
    )
    first = (
        kept.where("_v IS NOT NULL")
        .orderBy(F.col("_carried.c0").asc_nulls_last(), "_v")
        .limit(entries)
        .select("_v")
        .collect()
    )
    width = len(first[0]["_v"]) if first else 0
    start = [r["_v"] for r in first if len(r["_v"]) == width]
    outputs = [F.col(f"_carried.c{i}").alias(c) for i, c in enumerate(names)]
    none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
    coded_rows = F.coalesce(F.size("_v") == width, F.lit(False))
    others = kept.where(~coded_rows).select(*outputs, *none)
    if not width:
        # Nothing to code: no vector, or vectors without components, which are all alike.
        return VectorCodes(others if not first else kept.select(*outputs, *none), [])
    values = np.array(start, np.int64)
    codebooks = [np.ascontiguousarray(x) for x in np.array_split(values, parts, axis=1)]
    blocks = cut_lineage(_blocks(kept.where(coded_rows), parts, width))
    for _ in range(rounds):
        codebooks = next_codebooks(blocks, codebooks)
    carried = kept.schema["_carried"].dataType.simpleString()

    def run(batches):
        trees = [entry_tree(c) for c in codebooks]
        for row, held in _rows(batches):
            n = row["n"]
            codes, errors = np.empty((n, parts), np.uint8), np.zeros(n, np.int64)
            for position, tree in enumerate(_trees(row, parts)):
                code, error = coded(tree, codebooks[position], trees[position])
                codes[:, position] = code
                errors += error
            digits = codes.tobytes().hex()
            texts = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [held, pa.array(texts, pa.string()), pa.array(errors)], names=["_carried", "code", "error"]
            )

    found = blocks.mapInArrow(run, f"_carried {carried}, code string, error long")
    rows = found.select(*outputs, "code", "error").unionByName(others)
    return VectorCodes(cut_lineage(rows), codebooks)


# Groups whose sums are sent to all tasks; with more, both sides are shuffled.
BROADCAST_GROUPS = 100_000
# A hot group is dealt to this many shares in that join.
SHARES = 32


def with_group_sum(rows: DataFrame, group_col: str, value_col: str, output: str) -> DataFrame:
    """``rows`` with the sum of a column over the rows of its group; missing groups are one."""
    sums = cut_lineage(
        rows.groupBy(F.col(group_col).alias("_group")).agg(F.sum(value_col).alias("_sum"))
    )
    same = F.col(group_col).eqNullSafe(F.col("_group"))
    if sums.count() <= BROADCAST_GROUPS:
        joined = rows.join(F.broadcast(sums), same, "left")
    else:
        dealt = rows.withColumn("_share", F.pmod(F.monotonically_increasing_id(), F.lit(SHARES)))
        shares = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("_of"))
        joined = dealt.join(shares, same & (F.col("_share") == F.col("_of")), "left")
    return joined.select(*rows.columns, F.col("_sum").alias(output))
