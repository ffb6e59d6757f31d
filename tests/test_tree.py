"""File trees, their changes as a stream, and streams over runs."""

import json
import os
import time

import pytest

import kotonoha as k
from kotonoha.sources import files as file_source
from kotonoha.sources import tree
from kotonoha.streaming.streams import _run_of_batch, stream_content, stream_files, stream_tokens

NAMES = ["a.txt", "_b.txt", ".c.txt", "_d/e.txt", "sub/f.txt", "empty.txt", "sub/deep/er/g h[1].txt"]


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "texts"
    for name in NAMES:
        write(folder / name, "" if name == "empty.txt" else f"text of {name}")
    write(folder / "_skip.md", "other kind")
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return k.CorpusStore(spark, str(tmp_path / "store"))


def write(path, text, mtime=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if mtime:
        os.utime(path, (mtime, mtime))


def below(root, rows):
    return sorted(r["path"].split(str(root), 1)[1].lstrip("/") for r in rows)


def texts_of(store):
    rows = store.texts().join(store.documents(), "doc_id").select("rel_path", "text").collect()
    return {r["rel_path"]: r["text"] for r in rows}


def errors_of(store):
    rows = store.fetch_status().join(store.documents(), "doc_id").where("error_message IS NOT NULL").collect()
    return {r["rel_path"]: r["error_message"] for r in rows}


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_listing_level_by_level(spark, files):
    listed = file_source.list_files(spark, str(files)).collect()
    assert below(files, listed) == sorted(NAMES)
    assert {r["length"] for r in listed if r["path"].endswith("empty.txt")} == {0}
    twice = file_source.list_files(spark, [str(files), str(files / "sub"), str(files / "gone")], "*")
    assert below(files, twice.collect()) == sorted([*NAMES, "_skip.md"])


def test_a_root_of_many_folders_is_dealt_out(spark, tmp_path):
    for i in range(60):
        write(tmp_path / "root" / f"f{i:02d}" / "x.txt", str(i))
    folder = file_source.qualified(spark, str(tmp_path / "root"))
    options = {"path": folder, "slices": "10", "patterns": '["*.txt"]'}
    parts = tree.TreeReader(options).partitions()
    assert 9 <= len(parts) <= 10 and max(len(p.folders) for p in parts) <= 7
    found = [r for p in parts for b in tree.TreeReader(options).read(p) for r in b.to_pylist()]
    assert len(found) == 60
    tree.register_sources(spark)
    assert spark.read.format("file_tree").option("slices", "7").load(folder).count() == 60


def test_windows_hold_changes_only(spark, files):
    past = time.time() - 1000
    for top, _, names in os.walk(files):
        for name in names:
            os.utime(os.path.join(top, name), (past, past))
    for top, _, _ in os.walk(files, topdown=False):
        os.utime(top, (past, past))
    options = {"path": file_source.qualified(spark, str(files)), "patterns": json.dumps(["*.txt"])}
    reader = tree.TreeStream(options)

    def window(start, end):
        rows = [r for p in reader.partitions(start, end) for b in reader.read(p) for r in b.to_pylist()]
        return below(files, rows)

    now = {"until": int((past + 500) * 1e6)}
    assert window(reader.initialOffset(), now) == sorted(NAMES)
    later = reader.latestOffset()
    assert window(now, later) == []
    write(files / "sub" / "f.txt", "changed")
    os.utime(files / "sub", (past, past))
    assert window(now, later) == ["sub/f.txt"]
    # A file that is moved in keeps its old time; its folder's time tells.
    outside = files.parent / "old.txt"
    write(outside, "moved", past)
    outside.rename(files / "sub" / "deep" / "old.txt")
    assert window(now, later) == sorted(["sub/f.txt", "sub/deep/old.txt", "sub/deep/er/g h[1].txt"])


def test_stream_of_files(store, files, tmp_path):
    def stream():
        run(stream_files(store, str(files), checkpoint=str(tmp_path / "checkpoint")))

    stream()
    assert set(texts_of(store)) == set(NAMES)
    runs = store.fetch_table.runs()
    # A hidden and an empty file come without any other file.
    write(files / "_late.txt", "late")
    write(files / "none.txt", "")
    later = time.time() + 50
    write(files / "a.txt", "changed", later)
    stream()
    found = texts_of(store)
    assert (found["_late.txt"], found["none.txt"], found["a.txt"]) == ("late", "", "changed")
    assert len(store.fetch_table.runs()) == len(runs) + 1
    versions = {r["doc_id"]: r["text_version"] for r in store.fetch_status().collect()}
    assert len([v for v in versions.values() if v > max(runs)]) == 3  # the others were not read again
    # Only the newest note of a stream stays.
    assert len(list((tmp_path / "store" / "streams" / "files").glob("batch=*"))) == 1


def test_a_file_that_vanishes_is_its_documents_error(store, files, monkeypatch):
    store.register_files(str(files))
    listing = store._listing

    def then_remove():
        found = listing()
        found.count()
        (files / "a.txt").unlink(missing_ok=True)
        (files / "_b.txt").unlink(missing_ok=True)
        return found

    monkeypatch.setattr(store, "_listing", then_remove)
    store.process()
    assert errors_of(store) == {"a.txt": "file not found", "_b.txt": "file not found"}
    assert set(texts_of(store)) == set(NAMES) - {"a.txt", "_b.txt"}
    assert store.tokens().select("doc_id").distinct().count() == len(NAMES) - 3  # one text is empty


def test_a_vanished_file_keeps_its_earlier_text(store, files):
    store.register_files(str(files))
    store.process()
    wanted = store.documents().where("rel_path = 'a.txt'")
    (files / "a.txt").unlink()
    decoded = file_source.decode_utf8(store._contents(wanted))
    store._store_decoded(decoded, store.next_master_run())
    assert texts_of(store)["a.txt"] == "text of a.txt" and errors_of(store) == {"a.txt": "file not found"}


def test_unreadable_paths_are_errors(spark, tmp_path):
    (tmp_path / "folder.txt").mkdir()
    rows = [(1, f"file:{tmp_path}/folder.txt"), (2, "nostore://x/y.txt"), (3, f"file:{tmp_path}/none.txt")]
    found = file_source.read_files(spark.createDataFrame(rows, "doc_id long, abs_path string")).collect()
    assert all(r["content"] is None and r["problem"] for r in found)
    assert {r["doc_id"]: r["problem"] for r in found}[3] == "file not found"


def words(store):
    rows = store.word_lists().join(store.documents(), "doc_id").collect()
    return {r["rel_path"]: list(r["words"]) for r in rows}


@pytest.fixture
def feed(spark, store, tmp_path):
    schema = "id string, text string"
    source = str(tmp_path / "in")

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        run(stream_content(store, stream, "id", "text", checkpoint=str(tmp_path / "c1")))

    return arrive


def test_token_stream_started_again_after_compaction(store, feed, tmp_path):
    def tokenize():
        run(stream_tokens(store, checkpoint=str(tmp_path / "c2")))

    feed(("a", "one two"), ("b", "x"))
    tokenize()
    done = store.work_table.read().where("event = 'done'").count()
    store.compact(drop_older=True)
    tokenize()
    assert store.work_table.read().where("event = 'done'").count() == done  # nothing twice
    feed(("c", "new one"), ("a", "three"))
    store.compact()
    feed(("d", "newer"))
    tokenize()
    assert words(store) == {"a": ["three"], "b": ["x"], "c": ["new", "one"], "d": ["newer"]}
    assert store.pending().count() == 0


def test_live_token_stream_across_compaction(store, feed, tmp_path):
    feed(("a", "one"))
    query = stream_tokens(store, checkpoint=str(tmp_path / "c2"), available_now=False)
    try:
        query.processAllAvailable()
        store.compact(drop_older=True)
        feed(("b", "two"))
        store.compact(drop_older=True)
        query.processAllAvailable()
        assert words(store) == {"a": ["one"], "b": ["two"]} and query.exception() is None
    finally:
        query.stop()


def test_a_late_run_is_a_window_of_its_own(spark, store, tmp_path):
    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "original_id string, text string")

    def tokenize():
        run(stream_tokens(store, checkpoint=str(tmp_path / "c2")))

    noted = _run_of_batch(store, "content", 0, store.next_master_run)
    store.register_content(rows(("x", "first")))
    tokenize()
    store.register_content(rows(("y", "late")), run_id=noted)
    tokenize()
    assert words(store) == {"x": ["first"], "y": ["late"]}
