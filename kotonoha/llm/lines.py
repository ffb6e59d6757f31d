"""Corpus-wide removal of repeated lines through sorted line hashes.

1. Every text gives one thin row per distinct line: 128-bit hash of the line's
   key, document, positions.
2. The rows are range-partitioned by (hash, document) and sorted by (hash,
   document, position). Range bounds run through a hash, so a line that stands
   in a third of all documents is dealt over many tasks.
3. Each task streams over its rows once: it counts documents per hash, holds
   back at most ``min_docs - 1`` documents of a hash, and passes rows on as soon
   as the hash is known to be frequent. Only the first and the last hash of a
   task may continue elsewhere; their counts, two per task, are summed apart.
4. What comes out is not text but one compressed keep bitmap per document that
   loses lines.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.common import LOWER_BYTES, column, free_names, slices, utf8
from kotonoha.plans.layout import cut_lineage

# Rows of one hash that a task may hold back.
HELD_ROWS = 4096

DROP, UNDECIDED, COUNT = 0, 1, 2


def line_keys(text: str | None) -> list[bytes]:
    """Key of each line: outer white space stripped, A-Z in lower case."""
    return [line.strip() for line in utf8(text).translate(LOWER_BYTES).split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (
        len(key) >= 4 * min_chars or len(key.decode("utf-8", "surrogatepass")) >= min_chars
    )


def line_rows(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(_hash, _doc, _text_hash, _n_lines, _positions): a row per document and distinct key."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(
        F.col(id_col).alias("_doc"),
        F.xxhash64(text_col).alias("_text_hash"),
        F.col(text_col).alias("_text"),
    )
    names = ["_hash", "_doc", "_text_hash", "_n_lines", "_positions"]

    def run(batches):
        for batch in slices(batches):
            hashes, rows, counts, positions = [], [], [], []
            for row, text in enumerate(column(batch, "_text")):
                places: dict[bytes, list[int]] = {}
                keys = line_keys(text)
                for place, key in enumerate(keys):
                    if key:
                        places.setdefault(key, []).append(place)
                for key, found in places.items():
                    if _long_enough(key, min_chars):
                        hashes.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        counts.append(len(keys))
                        positions.append(found)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes, pa.binary()),
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(counts, pa.int32()),
                    pa.array(positions, pa.list_(pa.int32())),
                ],
                names=names,
            )

    return source.mapInArrow(
        run,
        f"_hash binary, _doc {id_type}, _text_hash long, _n_lines int, _positions array<int>",
    )


def _stream(batches, min_docs: int):
    """Rows of frequent hashes, undecided rows, and counts of the hashes at the task's ends."""
    schema = None
    current, count, last_doc, held, shared = None, 0, None, [], True
    out: list[tuple] = []

    def close(at_end: bool):
        nonlocal held
        if current is not None and (shared or at_end):
            out.append((COUNT, current, None, None, None, None, count))
            out.extend((UNDECIDED, current, *row, None) for row in held)
        held = []

    def batch_of(rows):
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema
        )

    for batch in batches:
        if schema is None:
            doc_type = batch.schema.field("_doc").type
            schema = pa.schema(
                [("_kind", pa.int32()), ("_hash", pa.binary()), ("_doc", doc_type), ("_text_hash", pa.int64()),
                 ("_n_lines", pa.int32()), ("_positions", pa.list_(pa.int32())), ("_count", pa.int64())]
            )
        hashes, docs = column(batch, "_hash"), column(batch, "_doc")
        texts, sizes = column(batch, "_text_hash"), column(batch, "_n_lines")
        for i, key in enumerate(hashes):
            doc = docs[i] if docs[i] is not None else (texts[i],)
            if key != current:
                first = current is None
                close(at_end=False)
                current, count, last_doc, shared = key, 1, doc, first
            elif doc != last_doc:
                count += 1
                last_doc = doc
            row = (docs[i], texts[i], sizes[i], batch.column(4)[i].as_py())
            if count < min_docs:
                held.append(row)
                if len(held) > HELD_ROWS:  # one document in very many rows
                    out.extend((UNDECIDED, key, *r, None) for r in held)
                    held, shared = [], True
                continue
            if held:
                out.extend((DROP, key, *r, None) for r in held)
                held = []
            out.append((DROP, key, *row, None))
            if len(out) >= HELD_ROWS:
                yield batch_of(out)
                out = []
    close(at_end=True)
    if out:
        yield batch_of(out)


def _bitmap(n_lines: int, dropped) -> bytes:
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes())


def keep_bitmaps(
    docs: DataFrame,
    *,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, text_hash, n_lines, n_dropped, keep) for each document that loses lines.

    A line goes when its key has at least ``min_chars`` code points and stands in
    at least ``min_docs`` documents; then it goes everywhere. Documents are told
    apart by id; rows without an id count as one document per distinct text.
    ``keep`` is a zlib-compressed bit per line. Documents that are not listed
    keep all lines; a missing or empty text is one empty line, which always stays.
    An empty table gives no rows.
    """
    rows = line_rows(docs, min_chars, id_col, text_col)
    id_type = docs.schema[id_col].dataType.simpleString()
    doc, text = F.col("_doc"), F.col("_text_hash")
    # Rows without an id are told apart by their text.
    apart = F.when(doc.isNull(), text)
    found = (
        rows.repartitionByRange("_hash", "_doc", apart)
        .sortWithinPartitions("_hash", "_doc", "_text_hash", F.col("_positions")[0])
        .mapInArrow(
            lambda batches: _stream(batches, min_docs),
            f"_kind int, _hash binary, _doc {id_type}, _text_hash long, _n_lines int, "
            "_positions array<int>, _count long",
        )
    )
    found = cut_lineage(found)
    # At most two hashes per task are counted apart.
    late = (
        found.where(F.col("_kind") == COUNT)
        .groupBy("_hash")
        .agg(F.sum("_count").alias("_total"))
        .where(F.col("_total") >= min_docs)
        .select("_hash")
    )
    dropped = found.where(F.col("_kind") == DROP).unionByName(
        found.where(F.col("_kind") == UNDECIDED).join(F.broadcast(late), "_hash", "left_semi").select(found.columns)
    )
    merged = dropped.groupBy("_doc", "_text_hash").agg(
        F.first("_n_lines").alias("_n_lines"), F.collect_set("_positions").alias("_lists")
    )

    def pack(batches):
        for batch in batches:
            sizes, drops = column(batch, "_n_lines"), column(batch, "_lists")
            flat = [np.unique(np.concatenate([np.asarray(p, np.int64) for p in lists])) for lists in drops]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array([len(f) for f in flat], pa.int64()),
                    pa.array([_bitmap(n, f) for n, f in zip(sizes, flat, strict=True)], pa.binary()),
                ],
                names=["_doc", "text_hash", "n_lines", "n_dropped", "keep"],
            )

    return merged.mapInArrow(
        pack, f"_doc {id_type}, text_hash long, n_lines long, n_dropped long, keep binary"
    ).withColumnRenamed("_doc", id_col)


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with kept lines only, and _n_lines and _n_dropped (long) behind their columns.

    A missing text stays missing and counts as one line. All other columns pass
    through untouched.
    """
    doc, text_hash, n_dropped, bits_of = free_names(docs.columns, "_doc", "_hash", "_drops", "_bits")
    marks = bitmaps.select(
        F.col(id_col).alias(doc),
        F.col("text_hash").alias(text_hash),
        F.col("n_dropped").alias(n_dropped),
        F.col("keep").alias(bits_of),
    ).hint("shuffle_hash")
    same = F.col(text_hash) == F.xxhash64(docs[text_col])
    joined = docs.join(marks, docs[id_col].eqNullSafe(F.col(doc)) & same, "left").drop(doc, text_hash)
    pass_on = range(len(docs.columns))

    names = [*docs.columns, "_n_lines", "_n_dropped"]

    def run(batches):
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            counts, texts = [], []
            for text, keep in zip(batch.column(at).to_pylist(), column(batch, bits_of), strict=True):
                lines = (text or "").split("\n")
                counts.append(len(lines))
                if keep is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                    text = "\n".join([lines[i] for i in np.flatnonzero(bits)])
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            dropped = batch.column(batch.schema.get_field_index(n_dropped)).fill_null(0)
            yield pa.RecordBatch.from_arrays(
                [*[columns[i] for i in pass_on], pa.array(counts, pa.int64()), dropped],
                names=names,
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(run, f"{fields}, _n_lines long, _n_dropped long")


def drop_repeated_lines(
    docs: DataFrame,
    *,
    min_docs: int = 10,
    min_chars: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Bitmaps made and applied: the documents, their kept text, _n_lines and _n_dropped."""
    bitmaps = keep_bitmaps(docs, min_docs=min_docs, min_chars=min_chars, id_col=id_col, text_col=text_col)
    return apply_bitmaps(docs, bitmaps, id_col=id_col, text_col=text_col)
