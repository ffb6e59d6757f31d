"""Views from a kept state and newer runs equal those from the whole log."""

import random

import pytest
from pyspark.sql import functions as F

import kotonoha as k
from kotonoha.plans import snapshots, status
from kotonoha.plans.store import LogTable
from kotonoha.schemas import FETCH_LOG, TOKENIZE_LOG
from kotonoha.streaming.streams import stream_tokens
from tests.conftest import rows_of

LOGS = {
    "fetch": (FETCH_LOG, snapshots.FETCH_RULE, ["registered", "fetched", "error"]),
    "work": (TOKENIZE_LOG, snapshots.WORK_RULE, ["registered", "done", "error", "reset"]),
}


def rows_for(spark, schema, run, kinds, docs, seed):
    """One event of a run for each document."""
    draw = random.Random(f"{seed}-{run}")
    rows = [(d, draw.choice(kinds), run * 100 + d, draw.choice([None, f"e{run}"]), draw.randrange(3)) for d in docs]
    frame = spark.createDataFrame(rows, "doc_id long, event string, at long, error string, text_version long")
    frame = frame.withColumn("at", F.timestamp_seconds("at"))
    return frame.select(*[
        F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema if f.name != "run_id"
    ])


def whole(log, rule):
    """The state without any snapshot."""
    return rows_of(rule.fold(rule.events(log.read())), "doc_id")


def kept(log, rule):
    return rows_of(snapshots.read_state(log, rule).select(*[f.name for f in rule.schema]), "doc_id")


@pytest.fixture(params=sorted(LOGS))
def log(request, spark, tmp_path):
    schema, rule, kinds = LOGS[request.param]
    table = LogTable(spark, str(tmp_path / "log"), schema)

    def add(run, docs, seed=0):
        table.append(rows_for(spark, schema, run, kinds, docs, seed), run)

    return table, rule, add


def test_states_are_equal_after_every_run(log, monkeypatch):
    table, rule, add = log
    assert kept(table, rule) == []
    snapshots.write_snapshot(table, rule)  # an empty log has nothing to keep
    assert snapshots.newest_snapshot(table) is None
    for run in range(1, 7):
        add(run, range(run % 3, 9 + run))
        if run % 2 == 0:
            snapshots.write_snapshot(table, rule)
            assert snapshots.newest_snapshot(table) == run and snapshots.runs_since(table) == 0
        assert kept(table, rule) == whole(table, rule)
    # Only the newest ones stay, and many new documents take the other way.
    assert table.names(f"{table.folder}/_state", "upto=") == [4, 6]
    add(7, range(5, 30))
    monkeypatch.setattr(snapshots, "BROADCAST_DOCUMENTS", 3)
    assert kept(table, rule) == whole(table, rule)


def test_older_runs_are_not_read(log):
    table, rule, add = log
    add(1, range(5))
    add(2, range(5))
    snapshots.write_snapshot(table, rule)
    add(3, [1])
    assert table.read(after=2).inputFiles() and all("run_id=3/" in f for f in table.read(after=2).inputFiles())
    read = snapshots.read_state(table, rule).inputFiles()
    assert read and all("/_state/upto=2/" in f for f in read)
    # The kept state passes by the shuffle but for what is touched; alone it needs none.
    snapshots.write_snapshot(table, rule)
    plan = snapshots.read_state(table, rule)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "run_id=" not in plan


def test_a_run_written_again_makes_the_snapshot_stale(log):
    table, rule, add = log
    add(1, range(4))
    snapshots.write_snapshot(table, rule)
    add(2, range(4))
    add(3, range(4))
    snapshots.write_snapshot(table, rule)
    planned = snapshots.read_state(table, rule)
    before = rows_of(planned, "doc_id")
    add(2, range(2, 8), seed=1)  # a repeated batch
    assert snapshots.newest_snapshot(table) == 1
    assert kept(table, rule) == whole(table, rule)
    assert rows_of(planned, "doc_id") == before  # its reader goes on
    snapshots.write_snapshot(table, rule)
    assert snapshots.newest_snapshot(table) == 3 and kept(table, rule) == whole(table, rule)
    add(1, [50], seed=2)
    assert snapshots.newest_snapshot(table) is None and kept(table, rule) == whole(table, rule)


def test_half_a_snapshot_does_not_count(log):
    table, rule, add = log
    add(1, range(4))
    snapshots.write_snapshot(table, rule)
    table.remove(f"{table.folder}/_state/upto=1/_SUCCESS")
    assert snapshots.newest_snapshot(table) is None and kept(table, rule) == whole(table, rule)


def content(spark, rows):
    return spark.createDataFrame(rows, "original_id string, text string")


def views(store):
    runs = status.visible_runs(store._work_state())
    return [
        rows_of(v, "doc_id")
        for v in (store.fetch_status(), store.tokenize_status(), store.pending(), runs, store.word_lists())
    ]


def test_store_and_streams_go_on_across_snapshots_and_compaction(spark, tmp_path):
    store = k.CorpusStore(spark, str(tmp_path / "store"))
    checkpoint = str(tmp_path / "tokens")

    def stream():
        stream_tokens(store, checkpoint=checkpoint).awaitTermination()

    store.register_content(content(spark, [("a", "one"), ("b", "two words"), ("c", "")]))
    store.snapshot()
    stream()
    store.snapshot()
    store.register_content(content(spark, [("a", "one changed"), ("d", "four")]))
    assert [r["doc_id"] for r in store.pending().orderBy("doc_id").collect()] == [1, 4]
    stream()
    assert store.pending().count() == 0
    store.reset_tokens([2])
    with_state = views(store)
    store.compact(drop_older=True)
    assert snapshots.runs_since(store.fetch_table) == snapshots.runs_since(store.work_table) == 0
    assert views(store) == with_state
    store.register_content(content(spark, [("e", "five")]))
    stream()
    assert {r["doc_id"]: r["words"] for r in store.word_lists().collect()} == {
        1: ["one", "changed"], 4: ["four"], 5: ["five"],
    }
    assert [r["doc_id"] for r in store.pending().collect()] == [2]


def test_process_folds_the_state_now_and_then(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("kotonoha.plans.store.SNAPSHOT_RUNS", 2)
    folder = tmp_path / "texts"
    folder.mkdir()
    (folder / "a.txt").write_text("one")
    store = k.CorpusStore(spark, str(tmp_path / "store"))
    store.register_files(str(folder))
    store.process()
    assert snapshots.newest_snapshot(store.fetch_table) == 2
    assert store.tokenize_status().where("tokenize_ok").count() == 1
