"""Best-fit packing with large-item matching, for documents in any order.

A bin is a sequence of ``capacity`` tokens, an item a piece of a document. Items
above a third of the capacity stand at most twice in a bin, so they are paired
by a greedy matching: the largest with the largest that still fits beside it,
which gives the most pairs there can be. The smaller items then go, largest
first, each into the fullest bin that has room; new bins open when none has.

Only sizes matter, and there are at most ``capacity`` of them. So the plan is
made on the counts of the sizes over all items: bins of equal content are one
group with a number of bins, and matching and best fit move whole groups. The
plan's size depends on the capacity alone, never on the number of documents.

Spark then deals the items out: each has a rank among the items of its size (its
place in its input split plus the counts of earlier splits), and the plan says
which ranks of a size fill which place of which bins. Texts are read once and
never shuffled; only thin rows, one per piece, are.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kotonoha.llm.bpe import ByteLevelBpe
from kotonoha.llm.common import column, slices
from kotonoha.plans.layout import cut_lineage

CAPACITY = 1024


def matched_pairs(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(sizes, bins) of the items above a third of the capacity, one or two in a bin."""
    left = {s: n for s, n in counts.items() if 3 * s > capacity and n}
    sizes = sorted(left)
    found = []

    def take(size: int, n: int) -> None:
        left[size] -= n
        if not left[size]:
            sizes.pop(bisect_left(sizes, size))

    while sizes:
        size = sizes[-1]
        # The largest that fits beside it; itself only if there are two.
        at = bisect_right(sizes, min(size, capacity - size)) - 1
        if at >= 0 and sizes[at] == size and left[size] == 1:
            at -= 1
        if at < 0:
            found.append(((size,), left[size]))
            take(size, left[size])
        elif sizes[at] == size:
            n = left[size] // 2
            found.append(((size, size), n))
            take(size, 2 * n)
        else:
            partner = sizes[at]
            n = min(left[size], left[partner])
            found.append(((size, partner), n))
            take(size, n)
            take(partner, n)
    return found


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Groups of equal bins: ((size, items), ...) of one bin in order, and the number of bins.

    ``counts`` has the number of items of each size from 1 to ``capacity``.
    """
    # Groups by what is left in their bins; ``gaps`` are the keys in order.
    groups: dict[int, list] = defaultdict(list)
    gaps: list[int] = []

    def put(gap: int, held: tuple, bins: int) -> None:
        if bins:
            if not groups[gap]:
                insort(gaps, gap)
            groups[gap].append((held, bins))

    for sizes, bins in matched_pairs(counts, capacity):
        # Equal sizes stand together, as everywhere in a plan.
        held = ((sizes[0], 2),) if len(sizes) == 2 and sizes[0] == sizes[1] else tuple((s, 1) for s in sizes)
        put(capacity - sum(sizes), held, bins)
    for size in sorted((s for s, n in counts.items() if 3 * s <= capacity and n), reverse=True):
        left = counts[size]
        while left:
            at = bisect_left(gaps, size)
            if at < len(gaps):
                gap = gaps[at]
                held, bins = groups[gap].pop()
                if not groups[gap]:
                    gaps.pop(at)
            else:
                gap, held, bins = capacity, (), left
            # A bin that takes one item is then the fullest with room, until it has none.
            each = gap // size
            full = min(bins, left // each)
            put(gap - each * size, (*held, (size, each)), full)
            left -= full * each
            if full < bins:
                if left:
                    put(gap - left * size, (*held, (size, left)), 1)
                    full, left = full + 1, 0
                if held:
                    put(gap, held, bins - full)
    return [group for gap in gaps for group in groups[gap]]


def places(groups: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[int, np.ndarray]:
    """For each size rows (first rank, first bin, offset in the bin, items in a bin), by rank."""
    found, used, first_bin = defaultdict(list), defaultdict(int), 0
    for held, bins in groups:
        offset = 0
        for size, items in held:
            found[size].append((used[size], first_bin, offset, items))
            used[size] += bins * items
            offset += size * items
        first_bin += bins
    return {size: np.array(rows, np.int64) for size, rows in found.items()}


def cut_pieces(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length): pieces of ``capacity`` tokens, a shorter one first where it does not divide."""
    rest = tokens % capacity
    starts = range(rest, tokens, capacity)
    return [*([(0, rest)] if rest else []), *((s, capacity) for s in starts)]


def _pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """One row per piece with its split and its place among the split's pieces of its length."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(
        F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
        F.spark_partition_id().alias("_split"),
    )

    def run(batches):
        encoder = None
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            encoder = encoder or ByteLevelBpe(path)
            rows, found = [], []
            for row, text in enumerate(column(batch, "_text")):
                ids = encoder.encode(text) if text else np.zeros(0, np.uint32)
                held = np.append(ids, np.uint32(end_id)).astype("<u4", copy=False).tobytes()
                for piece, (start, length) in enumerate(cut_pieces(len(ids) + 1, capacity)):
                    crc = zlib.crc32(held[4 * start : 4 * (start + length)])
                    rows.append(row)
                    found.append((piece, start, length, crc, int(seen[length])))
                    seen[length] += 1
            if not rows:
                continue
            cols = zip(*found, strict=True)
            rows = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), *[pa.array(c, pa.int64()) for c in cols], batch.column(2).take(rows)],
                names=["_id", "piece", "start", "length", "ids_crc32", "_place", "_split"],
            )

    return source.mapInArrow(
        run,
        f"_id {id_type}, piece long, start long, length long, ids_crc32 long, _place long, _split int",
    )


def pack_best_fit(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in as few sequences of at most ``capacity`` tokens as best fit finds.

    One row per piece: the id, ``piece`` (from 0), ``start`` and ``length`` in
    tokens, ``ids_crc32`` of its ids, ``sequence_id`` and ``offset`` there, both
    from 0 without gaps. A document is its ids and then ``end_id``; a missing or
    empty text is that one id. A document above ``capacity`` is cut into pieces of
    that length, the first of which may be shorter; others stay whole. Ids may be
    missing or repeated: every row is packed by itself. Columns other than id and
    text are not read. An empty table gives no rows. Which of several pieces of
    one length goes where depends on the order of the input's splits.
    """
    pieces = cut_lineage(_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col))
    by_split = pieces.groupBy("_split", "length").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per size, whatever the number of documents.
    counts = {r["length"]: r["_n"] for r in by_split.groupBy("length").agg(F.sum("_n").alias("_n")).collect()}
    plan = places(plan_bins(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = by_split.select(
        F.col("_split").alias("_s"),
        F.col("length").alias("_l"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    ranked = pieces.join(
        before, (pieces["_split"] == before["_s"]) & (pieces["length"] == before["_l"])
    ).select("_id", "piece", "start", "length", "ids_crc32", (F.col("_place") + F.col("_before")).alias("_rank"))

    def placed(batches):
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            sequence = np.zeros(len(rank), np.int64)
            offset = np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                rows = plan[size]
                first, first_bin, start, items = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1].T
                behind = rank[at] - first
                sequence[at] = first_bin + behind // items
                offset[at] = start + size * (behind % items)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    outputs = "piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    found = ranked.mapInArrow(placed, f"_id {id_type}, {outputs}")
    return found.withColumn("piece", F.col("piece").cast("int")).withColumnRenamed("_id", id_col)
