"""Micro-batches into the corpus store, restartable and exactly once.

The run of a micro-batch is fixed before it writes anything: a small note under
the store names the run_id of (stream, batch_id). A repeated batch finds the
note, reads the state before that run and overwrites the run's directories.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kotonoha.plans import status
from kotonoha.plans.layout import cut_lineage
from kotonoha.plans.store import CorpusStore, LogTable, pick_rows
from kotonoha.schemas import FETCH_LOG
from kotonoha.sources import files as file_source
from kotonoha.sources.tree import as_patterns, register_sources


def _run_of_batch(store: CorpusStore, stream: str, batch_id: int, allocate: Callable[[], int]) -> int:
    """The run_id noted for this batch, noting a new one first if there is none.

    Only the last batch of a stream can come again, so a new note replaces the
    older ones of its stream.
    """
    spark = store.spark
    folder = f"{store.root}/streams/{stream}"
    path = f"{folder}/batch={batch_id}"
    notes = LogTable(spark, folder, FETCH_LOG)
    if not notes.exists(f"{path}/_SUCCESS"):
        spark.createDataFrame([(allocate(),)], "run long").coalesce(1).write.mode(
            "overwrite"
        ).parquet(path)
        for older in notes.names(folder, "batch="):
            if older < batch_id:
                notes.remove(f"{folder}/batch={older}")
    return spark.read.schema("run long").parquet(path).first()["run"]


def _start(stream: DataFrame, each_batch, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_files(
    store: CorpusStore,
    root_dir: str,
    patterns: str | Iterable[str] = file_source.DEFAULT_PATTERNS,
    *,
    checkpoint: str,
    name: str = "files",
    max_files: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Register and fetch new and changed files as they appear, of any name and size.

    A batch lists what changed since the one before; files among it whose text
    is already stored are left alone. ``max_files`` bounds the files one task reads.
    """
    register_sources(store.spark)
    options = {"patterns": json.dumps(as_patterns(patterns))}
    place = file_source.qualified(store.spark, root_dir)
    stream = store.spark.readStream.format("file_tree").options(**options).load(place)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        changed = cut_lineage(batch.select("path", "modificationTime").distinct())
        if changed.isEmpty():
            return
        run_id = _run_of_batch(store, name, batch_id, store.next_master_run)
        store.register_paths(changed.select("path"), root_dir, run_id=run_id)
        known = store.documents().join(changed.withColumnRenamed("path", "abs_path"), "abs_path")
        log = store.fetch_table.read(without=run_id).join(known.select("doc_id"), "doc_id", "left_semi")
        files = known.select(F.col("abs_path").alias("path"), "modificationTime")
        # Documents of this batch's own run count as not read yet.
        unread = known.select("doc_id").join(log, "doc_id", "left_anti")
        state = status.fetch_status(status.fetch_state(log)).unionByName(
            unread.withColumn("fetch_ok", F.lit(False)), allowMissingColumns=True
        )
        wanted = cut_lineage(status.select_updates(known, state, files))
        if max_files:
            wanted = wanted.repartition(max(1, -(-wanted.count() // max_files)))
        store._store_decoded(file_source.decode_utf8(store._contents(wanted)), run_id)

    return _start(stream, each_batch, checkpoint, available_now)


def stream_content(
    store: CorpusStore,
    stream: DataFrame,
    id_col: str,
    text_col: str,
    *,
    checkpoint: str,
    order_col: str | None = None,
    source_label: str = "imported",
    name: str = "content",
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert a stream of (id, text) rows batch by batch."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = _run_of_batch(store, name, batch_id, store.next_master_run)
        store.register_content(
            batch, id_col, text_col, order_col=order_col, source_label=source_label, run_id=run_id
        )

    return _start(stream, each_batch, checkpoint, available_now)


def stream_tokens(
    store: CorpusStore,
    tokenizer=None,
    *,
    checkpoint: str,
    word_form: str | None = None,
    name: str = "tokens",
    available_now: bool = True,
) -> StreamingQuery:
    """Tokenize newly stored texts: a stream over the runs of the fetch log.

    A batch reads the rows of new runs, which carry their texts and, as run_id,
    their versions, and looks at nothing else in the store. Runs keep their
    numbers when the store is compacted, so a stream goes on across a
    compaction, live or started again. A text replaced within one batch is
    tokenized in its newest version only.
    """
    register_sources(store.spark)
    options = {"path": store.qualified(store.fetch_table.path), "notes": store.qualified(f"{store.root}/streams")}
    windows = store.spark.readStream.format("run_windows").options(**options).load()

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        wanted = batch.collect()  # a window, and one for each late run
        if not wanted:
            return
        run_id = _run_of_batch(store, f"{name}-{store.work_name}", batch_id, store.next_work_run)
        new = reduce(or_, [(F.col("run_id") > w["after"]) & (F.col("run_id") <= w["until"]) for w in wanted])
        fetched = store.fetch_table.read().where(new).where("event = 'fetched'")
        newest = fetched.groupBy("doc_id").agg(F.max("run_id").alias("run_id"))
        texts = pick_rows(fetched, newest).withColumnRenamed("run_id", "text_version")
        store._tokenize_texts(texts, tokenizer, word_form, run_id)

    return _start(windows, each_batch, checkpoint, available_now)
