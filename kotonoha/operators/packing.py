"""Size-bounded grouping of documents, exact and distributed.

The rule is sequential: walk the documents in id order and open a new group
when the next one would push the open group over its character or document
limit. What a slice of the walk does depends only on the group that is open
when the walk arrives, and that group meets at most ``max_docs`` documents of
the slice. So every slice reports, for each place where the arriving group may
end, what is open at the slice's end. Reports of neighbouring stretches compose
to the report of both, so a tree of reports gives each slice its true arrival,
and the slices then number their documents in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.plans.layout import cut_lineage
from kotonoha.plans.numbering import range_slices
from kotonoha.schemas import require_columns

MAX_CHARS = 200_000
MAX_DOCS = 500
# Reports that one task composes or walks.
BLOCK_REPORTS = 64

_REPORT = (
    "key string, slice long, n long, total long, sums array<long>, closed array<long>, "
    "open_docs array<long>, open_chars array<long>"
)


_REPORT_COLUMNS = ["key", "slice", "n", "total", "sums", "closed", "open_docs", "open_chars"]


def _plain_keys(keys) -> pd.Series:
    """Keys as Python strings with None for a missing one."""
    return pd.Series([None if pd.isna(k) else k for k in keys], dtype=object)


def _next_starts(sums: np.ndarray, max_chars: int, max_docs: int) -> np.ndarray:
    """For a group starting at each row, the row that starts the next group."""
    n = len(sums) - 1
    rows = np.arange(n)
    over = np.searchsorted(sums, sums[:-1] + max_chars, side="right") - 1
    return np.minimum(np.maximum(over, rows + 1), rows + max_docs).clip(max=n)


def _arrival(sums: np.ndarray, docs: int, chars: int, max_chars: int, max_docs: int) -> int:
    """First row that no longer fits the arriving group (n = all fit)."""
    if docs == 0:
        return 0
    by_chars = int(np.searchsorted(sums, max_chars - chars, side="right")) - 1
    return min(max(by_chars, 0), max_docs - docs, len(sums) - 1)


def _chains(following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row the start of the last group that follows from it, and how many come between."""
    n = len(following)
    step = np.where(following < n, following, np.arange(n))
    groups = (following < n).astype(np.int64)
    # Jumps of doubled length, until all have arrived.
    while (groups[step] > 0).any():
        groups += groups[step]
        step = step[step]
    return step, groups


def _reached(following: np.ndarray, place: int) -> np.ndarray:
    """Marks of the rows that start a group when one starts at ``place``."""
    n = len(following)
    marks = np.zeros(n + 1, np.int64)
    found = np.array([place])
    jump = np.append(following, n)
    while len(found) and found[-1] < n:
        # All starts up to 2^k jumps away, then as many again.
        found = np.unique(np.concatenate([found, jump[found]]))
        jump = jump[jump]
    marks[found] = 1
    return marks[:n]


def _report(sizes: np.ndarray, max_chars: int, max_docs: int) -> dict:
    n = len(sizes)
    sums = np.concatenate([[0], np.cumsum(sizes)])
    last, closed = _chains(_next_starts(sums, max_chars, max_docs))
    seen = min(n, max_docs + 1)
    return {
        "n": n,
        "total": int(sums[n]),
        "sums": sums[: seen + 1],
        "closed": closed[:seen],
        "open_docs": n - last[:seen],
        "open_chars": sums[n] - sums[last[:seen]],
    }


def _arrays(row) -> dict:
    """A report from its row, with arrays."""
    arrays = {c: np.asarray(row[c], np.int64) for c in ("sums", "closed", "open_docs", "open_chars")}
    return {"n": int(row["n"]), "total": int(row["total"]), **arrays}


def _step(report: dict, docs: int, chars: int, groups: int, max_chars: int, max_docs: int) -> tuple[int, int, int]:
    """(open documents, open characters, closed groups) behind a report, from those before it."""
    p = _arrival(report["sums"], docs, chars, max_chars, max_docs)
    if p >= report["n"]:
        return docs + report["n"], chars + report["total"], groups
    closed = groups + int(report["closed"][p]) + (1 if docs else 0)
    return int(report["open_docs"][p]), int(report["open_chars"][p]), closed


def _composed(first: dict, second: dict, max_chars: int, max_docs: int) -> dict:
    """The report of two neighbouring stretches: the second after the first.

    A group that starts in the first stretch leaves an open one, which arrives
    at the second; one that starts in the second is as reported there.
    """
    docs, chars = first["open_docs"], first["open_chars"]
    by_chars = np.searchsorted(second["sums"], max_chars - chars, side="right") - 1
    p = np.minimum(np.minimum(np.maximum(by_chars, 0), max_docs - docs), len(second["sums"]) - 1)
    whole = p >= second["n"]
    at = np.minimum(p, max(0, len(second["closed"]) - 1))
    seen = min(first["n"] + second["n"], max_docs + 1)

    def joined(kept, left: str, extra=0):
        inside = np.where(whole, kept, second[left][at] + extra)
        return np.concatenate([inside, second[left]])[:seen]

    return {
        "n": first["n"] + second["n"],
        "total": first["total"] + second["total"],
        "sums": np.concatenate([first["sums"], first["total"] + second["sums"][1:]])[: seen + 1],
        "closed": joined(first["closed"], "closed", first["closed"] + 1),
        "open_docs": joined(docs + second["n"], "open_docs"),
        "open_chars": joined(chars + second["total"], "open_chars"),
    }


def _compose_block(part: pd.DataFrame, max_chars: int, max_docs: int) -> pd.DataFrame:
    """One report for the reports of a block, in order."""
    rows = part.sort_values("slice").to_dict("records")
    whole = reduce(lambda a, b: _composed(a, b, max_chars, max_docs), map(_arrays, rows))
    out = pd.DataFrame([{"slice": rows[0]["block"], **whole}])
    return out.assign(key=_plain_keys([rows[0]["key"]]))[_REPORT_COLUMNS]


def _walk_block(part: pd.DataFrame, max_chars: int, max_docs: int) -> pd.DataFrame:
    """What is open on arrival at every report of a block, from what is on arrival at the block."""
    rows = part.sort_values("slice").to_dict("records")
    state = tuple(int(rows[0][c]) for c in ("docs_in", "chars_in", "groups_in"))
    found = []
    for row in rows:
        found.append((row["slice"], *state))
        state = _step(_arrays(row), *state, max_chars, max_docs)
    out = pd.DataFrame(found, columns=["slice", "docs", "chars", "groups"])
    return out.assign(key=_plain_keys([r["key"] for r in rows]))[["key", "slice", "docs", "chars", "groups"]]


_ARRIVAL = "key string, slice long, docs long, chars long, groups long"


def _arrivals(reports: DataFrame, max_chars: int, max_docs: int) -> DataFrame:
    """``[key, slice, docs, chars, groups]`` on arrival at every slice.

    Reports are composed in blocks, the blocks' reports again, until a key has
    one block; the arrivals come down the same way. No task sees more than
    ``BLOCK_REPORTS`` reports of a key, whatever its number of slices.
    """
    levels = [cut_lineage(reports)]
    while True:
        top = levels[-1].withColumn("block", F.floor(F.col("slice") / BLOCK_REPORTS))
        if top.groupBy("key").agg(F.countDistinct("block").alias("_n")).where("_n > 1").isEmpty():
            break
        composed = top.groupBy("key", "block").applyInPandas(
            lambda part: _compose_block(part, max_chars, max_docs), _REPORT
        )
        levels.append(cut_lineage(composed))
    # A block is named by its number, so a slice of one level is a block of the level below.
    above = None
    for level in reversed(levels):
        placed = level.withColumn("block", F.floor(F.col("slice") / BLOCK_REPORTS))
        if above is None:
            zero = F.lit(0).cast("long")
            placed = placed.withColumn("docs_in", zero).withColumn("chars_in", zero).withColumn("groups_in", zero)
        else:
            into = above.select(
                F.col("key").alias("_k"), F.col("slice").alias("_b"),
                *[F.col(c).alias(f"{c}_in") for c in ("docs", "chars", "groups")],
            )
            placed = placed.join(into, F.col("key").eqNullSafe(F.col("_k")) & (F.col("block") == F.col("_b"))).drop("_k", "_b")
        above = cut_lineage(
            placed.groupBy("key", "block").applyInPandas(lambda part: _walk_block(part, max_chars, max_docs), _ARRIVAL)
        )
    return above


def pack_documents(
    docs: DataFrame,
    *,
    max_chars: int = MAX_CHARS,
    max_docs: int = MAX_DOCS,
    key_col: str | None = None,
    id_col: str = "doc_id",
    size_col: str = "char_count",
) -> DataFrame:
    """``[key?, doc_id, char_count, group_id]``; group_id counts from 0 per key.

    An oversize document is alone in its group; no document is split. Only
    (key, id, size) rows take part. A slice is one range partition; its report
    has at most ``max_docs`` entries, as has that of any number of slices together.
    """
    require_columns(docs, [id_col, size_col, *([key_col] if key_col else [])], "pack_documents")
    if max_docs < 1:
        raise ValueError("max_docs must be positive")
    key = F.col(key_col).cast("string") if key_col else F.lit("")
    lean = docs.select(
        key.alias("key"), F.col(id_col).alias("id"),
        F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("size"),
    )
    sliced = range_slices(lean, ["key"], ["id"]).drop("_place")

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The checkpoint keeps a slice in one task, already in order.
        for key_value, slice_id, part in _runs(batches):
            found = _report(part["size"].to_numpy(), max_chars, max_docs)
            row = pd.DataFrame([{"slice": slice_id, **found}])
            yield row.assign(key=_plain_keys([key_value]))[_REPORT_COLUMNS]

    reports = sliced.mapInPandas(report, _REPORT)
    arrivals = _arrivals(reports, max_chars, max_docs)
    # A key's first slice starts empty; only continuing slices need a row, at
    # most one per partition.
    carried = cut_lineage(arrivals.where(F.col("docs") > 0)).select(
        F.col("key").alias("_k"), F.col("slice").alias("_s"), "docs", "chars", "groups"
    )
    ready = sliced.join(
        F.broadcast(carried),
        F.col("key").eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")),
        "left",
    ).select(
        "key", "id", "size", "_slice",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("docs", "chars", "groups")],
    )

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, part in _runs(batches):
            sums = np.concatenate([[0], np.cumsum(part["size"].to_numpy())])
            n = len(part)
            docs_in, chars_in, groups_in = (int(part[c].iat[0]) for c in ("docs", "chars", "groups"))
            place = _arrival(sums, docs_in, chars_in, max_chars, max_docs)
            following = _next_starts(sums, max_chars, max_docs)
            begins = _reached(following, place) if place < n else np.zeros(n, dtype=np.int64)
            # With nothing open on arrival, the first start is group 0.
            group = groups_in + np.cumsum(begins) - (0 if docs_in else 1)
            rows = part[["key", "id", "size"]].assign(group_id=group)
            yield rows.assign(key=_plain_keys(rows["key"]))

    id_type = docs.schema[id_col].dataType.simpleString()
    out = ready.mapInPandas(assign, f"key string, id {id_type}, size long, group_id long")
    named = [F.col("id").alias(id_col), F.col("size").alias(size_col), "group_id"]
    return out.select(*([F.col("key").cast(docs.schema[key_col].dataType).alias(key_col)] if key_col else []), *named)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Whole (key, slice) runs of a sorted partition, one at a time."""
    held: list[pd.DataFrame] = []
    current = None
    for batch in batches:
        for run, part in batch.groupby(["key", "_slice"], sort=False, dropna=False):
            if held and run != current:
                yield (*current, pd.concat(held, ignore_index=True))
                held = []
            current = run
            held.append(part)
    if held:
        yield (*current, pd.concat(held, ignore_index=True))
