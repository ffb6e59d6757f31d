import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

import kotonoha as k
from kotonoha.plans import status
from kotonoha.sources.content import read_csv
from kotonoha.sources.files import as_glob
from kotonoha.streaming.streams import stream_content, stream_files, stream_tokens
from tests.conftest import rows_of


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "corpus"
    (folder / "sub [x]").mkdir(parents=True)
    (folder / "b.txt").write_bytes("second\r\nline".encode())
    (folder / "a.txt").write_bytes("今日は".encode())
    (folder / "sub [x]" / "c.txt").write_bytes("third".encode())
    (folder / "sub [x]" / "d.txt").write_bytes("日本".encode("cp932"))
    (folder / "other.md").write_bytes(b"markdown")
    return folder


@pytest.fixture
def store(spark, tmp_path):
    return k.CorpusStore(spark, str(tmp_path / "store"))


def touch(path, text, ahead):
    path.write_bytes(text.encode())
    later = dt.datetime.now().timestamp() + ahead
    os.utime(path, (later, later))


def by_path(store, df):
    names = store.documents().select("doc_id", "rel_path")
    return {r["rel_path"]: r for r in df.join(names, "doc_id").collect()}


def words(store):
    return {p: r["words"] for p, r in by_path(store, store.word_lists()).items()}


def test_register_is_ordered_and_repeatable(store, corpus):
    store.register_files(str(corpus))
    first = rows_of(store.documents().select("doc_id", "rel_path"), "doc_id")
    assert first == [(1, "a.txt"), (2, "b.txt"), (3, "sub [x]/c.txt"), (4, "sub [x]/d.txt")]
    store.register_files(str(corpus), ["*.txt", "*.md"])
    again = rows_of(store.documents().select("doc_id", "rel_path"), "doc_id")
    assert again == first + [(5, "other.md")]
    state = store.fetch_status()
    assert state.count() == 5 and state.where("fetch_ok").count() == 0
    assert as_glob("*.txt") == "*.txt" and as_glob(["*.b", "*.a"]) == "{*.a,*.b}"


def test_ingest_decode_update_and_charset(store, corpus):
    store.register_files(str(corpus))
    store.ingest()
    texts = by_path(store, store.texts())
    assert texts["a.txt"]["text"] == "今日は" and texts["a.txt"]["char_count"] == 3
    assert texts["b.txt"]["text"] == "second\nline"
    assert "sub [x]/d.txt" not in texts and "sub [x]/c.txt" in texts
    failed = store.failed_documents().collect()
    assert len(failed) == 1 and "UTF-8" in failed[0]["error_message"]

    store.tokenize()
    assert store.pending().count() == 0
    runs = store.fetch_table.runs()
    store.ingest(check_updates=True)  # only the failed file is tried again
    retried = store.fetch_table.read().where(F.col("run_id") > runs[-1]).collect()
    assert [r["event"] for r in retried] == ["error"]

    touch(corpus / "a.txt", "明日", ahead=60)
    store.ingest(check_updates=False)
    assert by_path(store, store.texts())["a.txt"]["text"] == "今日は"
    store.ingest()
    assert by_path(store, store.texts())["a.txt"]["text"] == "明日"
    # Pending again, and the old tokens stay readable until they are replaced.
    assert rows_of(store.pending().select("doc_id")) == [(1,)]
    assert words(store)["a.txt"] == ["今日", "は"]
    store.tokenize()
    assert words(store)["a.txt"] == ["明日"]

    store.redecode_failed("cp932")
    assert by_path(store, store.texts())["sub [x]/d.txt"]["text"] == "日本"
    assert store.failed_documents().count() == 0
    with pytest.raises(LookupError):
        store.redecode_failed("no-such-charset") if store.failed_documents().count() else "".encode("no-such")


def test_failed_refetch_keeps_the_text(store, corpus):
    store.register_files(str(corpus))
    store.ingest()
    later = dt.datetime.now().timestamp() + 60
    (corpus / "a.txt").write_bytes(b"\xff\xfe")
    os.utime(corpus / "a.txt", (later, later))
    store.ingest()
    state = by_path(store, store.fetch_status())["a.txt"]
    assert state["fetch_ok"] and "UTF-8" in state["error_message"]
    assert by_path(store, store.texts())["a.txt"]["text"] == "今日は"
    assert store.failed_documents().count() == 1  # only the never fetched one


def test_deleted_file_is_recorded_only_if_never_fetched(store, corpus):
    store.register_files(str(corpus))
    (corpus / "b.txt").unlink()
    store.ingest()
    assert by_path(store, store.fetch_status())["b.txt"]["error_message"] == "file not found"
    (corpus / "a.txt").unlink()
    store.ingest()
    assert by_path(store, store.fetch_status())["a.txt"]["error_message"] is None


def test_full_read_beyond_named_files(store, corpus, monkeypatch):
    monkeypatch.setattr("kotonoha.plans.store.NAMED_FILES", 1)
    store.register_files(str(corpus))
    store.ingest()
    assert len(by_path(store, store.texts())) == 3


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, seq long")


def test_content_upsert(spark, store):
    store.register_content(
        pairs(spark, [("x", "one", 1), ("y", None, 2), ("z", "", 3), ("x", "two", 4), ("x", None, 5)]),
        "id", "text", order_col="seq", source_label="db",
    )
    docs = rows_of(store.documents().select("doc_id", "abs_path"), "doc_id")
    assert docs == [(1, "db://x"), (2, "db://z")]
    assert rows_of(store.texts().select("doc_id", "text", "char_count"), "doc_id") == [(1, "two", 3), (2, "", 0)]
    store.tokenize()
    assert store.pending().count() == 0
    store.register_content(pairs(spark, [("w", "new", 1), ("x", "three", 2)]), "id", "text", order_col="seq", source_label="db")
    docs = rows_of(store.documents().select("doc_id", "abs_path"), "doc_id")
    assert docs[2:] == [(3, "db://w")] and len(docs) == 3
    assert rows_of(store.pending().select("doc_id"), "doc_id") == [(1,), (3,)]
    store.ingest()  # content documents are no files
    assert store.texts().count() == 3


def test_number_texts_are_not_texts(spark, store):
    store.register_content(spark.createDataFrame([(1, 5)], "id long, text long"), "id", "text")
    assert store.documents().count() == 0


def refuse(text):
    if "bad" in text:
        raise RuntimeError("refused")
    return [(w, "n", None) for w in text.split()]


def test_failing_documents_keep_their_state(spark, store):
    content = pairs(spark, [("a", "fine text", 1), ("b", "bad text", 2), ("c", "  ", 3)])
    store.register_content(content, "id", "text", order_col="seq")
    store.tokenize(k.text_tokenizer(refuse))
    state = by_path(store, store.tokenize_status())
    assert state["a"]["tokenize_ok"] and state["c"]["tokenize_ok"]
    assert not state["b"]["tokenize_ok"] and "refused" in state["b"]["error_message"]
    assert rows_of(store.pending().select("doc_id")) == [(2,)]
    store.tokenize()
    assert store.pending().count() == 0 and by_path(store, store.tokenize_status())["b"]["error_message"] is None
    store.tokenize(k.text_tokenizer(refuse), doc_ids=[1, 2])  # forced: 2 fails, its tokens stay
    state = by_path(store, store.tokenize_status())
    assert state["b"]["tokenize_ok"] and "refused" in state["b"]["error_message"]
    assert words(store) == {"a": ["fine", "text"], "b": ["bad", "text"]}
    before = store.work_table.runs()
    store.tokenize(doc_ids=[])
    assert store.work_table.runs() == before


def test_reset_sync_and_works(spark, store):
    content = pairs(spark, [("a", "x y", 1), ("b", "z", 2), ("c", "", 3)])
    store.register_content(content, "id", "text", order_col="seq")
    store.tokenize()
    other = store.with_work("other")
    assert other.pending().count() == 3
    other.sync_status()
    assert other.work_table.read().where("event = 'registered'").count() == 3
    other.sync_status()
    assert other.work_table.read().count() == 3
    store.reset_tokens([])
    assert store.pending().count() == 0
    store.reset_tokens([2])
    assert words(store) == {"a": ["x", "y"]}
    assert rows_of(store.pending().select("doc_id")) == [(2,)]
    store.reset_tokens()
    assert store.tokens().count() == 0 and store.pending().count() == 3
    store.tokenize()
    assert words(store) == {"a": ["x", "y"], "b": ["z"]}


def test_derive_and_compact(spark, store):
    content = pairs(spark, [("a", "x 1 y", 1), ("b", "2", 2), ("c", "bad", 3)])
    store.register_content(content, "id", "text", order_col="seq")
    store.tokenize()
    kept = store.derive("words", lambda t: k.filter_tokens(t, pos_keep="word"))
    assert words(kept) == {"a": ["x", "y"], "c": ["bad"]}
    assert kept.tokenize_status().where("tokenize_ok").count() == 3

    def pandas_transform(frame):
        if (frame["word"] == "bad").any():
            raise ValueError("bad word")
        return frame[frame["pos"] == "word"]

    again = store.derive("words", pandas_transform, pandas=True)
    assert words(again) == {"a": ["x", "y"]}
    state = by_path(again, again.tokenize_status())
    assert not state["c"]["tokenize_ok"] and "bad word" in state["c"]["error_message"]

    def damaged(table):
        return table.withColumn("token_id", F.when(F.col("doc_id") == 1, 0).otherwise(F.col("token_id")))

    third = store.derive("damaged", damaged)
    assert by_path(third, third.tokenize_status())["a"]["error_message"] == "duplicate"
    assert words(third) == {"b": ["2"], "c": ["bad"]}
    assert words(store.derive("nothing", lambda t: None)) == {}

    status_before = sorted(rows_of(again.tokenize_status().select("doc_id", "tokenize_ok", "error_message")))
    again.compact()
    assert again.work_table.generation() == 1
    assert words(again) == {"a": ["x", "y"]}
    assert sorted(rows_of(again.tokenize_status().select("doc_id", "tokenize_ok", "error_message"))) == status_before
    again.tokenize(doc_ids=[2])
    assert words(again) == {"a": ["x", "y"], "b": ["2"]}


def test_replace_tokens_checks_the_contract(spark, store, tokens):
    content = pairs(spark, [("a", "x", 1), ("b", "y", 2), ("c", "z", 3)])
    store.register_content(content, "id", "text", order_col="seq")
    store.tokenize()
    table = k.fit_schema(tokens([(1, 1, "new", "n"), (2, 1, "p", "n"), (2, 1, "q", "n")]))
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    problems = rows_of(store.replace_tokens(table, docs))
    assert problems == [(2, "duplicate", 2)]
    assert words(store) == {"a": ["new"], "b": ["y"]}


def test_crashed_run_is_invisible_and_repeatable(spark, store):
    store.register_content(pairs(spark, [("a", "x", 1)]), "id", "text", order_col="seq")
    run = store.next_master_run()
    # A run that died after its registry part.
    fresh = spark.createDataFrame([("imported://n", "n", 1)], "abs_path string, rel_path string, o long")
    store._register(fresh, "o", "content", run)
    assert store.texts().count() == 1
    store.register_content(pairs(spark, [("n", "t", 1), ("m", "u", 2)]), "id", "text", order_col="seq", run_id=run)
    docs = rows_of(store.documents().select("doc_id", "abs_path"), "doc_id")
    assert docs == [(1, "imported://a"), (2, "imported://n"), (3, "imported://m")]


def test_csv_keeps_empty_and_line_breaks(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,text\n1,"a\n""b"""\n2,""\n3,\n', encoding="utf-8")
    found = {r["original_id"]: r["text"] for r in read_csv(spark, str(tmp_path / "in.csv"), "id", "text").collect()}
    assert found["1"] == 'a\n"b"' and found["2"] == "" and found["3"] is None


def test_margin_of_one_second(spark):
    at = dt.datetime(2024, 1, 1, 12)
    docs = spark.createDataFrame([(i, f"p{i}", "file") for i in range(5)], "doc_id long, abs_path string, source_kind string")
    state = spark.createDataFrame(
        [(0, True, at), (1, True, at), (2, True, None), (3, False, None), (4, True, at)],
        "doc_id long, fetch_ok boolean, fetched_at timestamp",
    )
    files = spark.createDataFrame(
        [("p0", at + dt.timedelta(seconds=1)), ("p1", at + dt.timedelta(seconds=1, microseconds=1)), ("p2", at)],
        "path string, modificationTime timestamp",
    )
    assert rows_of(status.select_updates(docs, state, files).select("doc_id"), "doc_id") == [(1,), (2,), (3,)]
    plain = status.select_updates(docs, state, files, check_updates=False)
    assert rows_of(plain.select("doc_id")) == [(3,)]


# -- streams -------------------------------------------------------------------------


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_file_stream_restarts_where_it_stopped(store, corpus, tmp_path):
    options = {"checkpoint": str(tmp_path / "cp"), "max_files": 1}
    run(stream_files(store, str(corpus), **options))
    assert len(by_path(store, store.texts())) == 3 and store.failed_documents().count() == 1
    (corpus / "e.txt").write_bytes(b"late")
    run(stream_files(store, str(corpus), **options))
    texts = by_path(store, store.texts())
    assert texts["e.txt"]["text"] == "late" and len(texts) == 4
    ids = rows_of(store.documents().select("doc_id"), "doc_id")
    assert [i for i, in ids] == [1, 2, 3, 4, 5]


def test_content_and_token_streams(spark, store, tmp_path):
    source = tmp_path / "in"
    schema = "id string, text string, seq long"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))

    def upsert():
        stream = spark.readStream.schema(schema).parquet(str(source))
        run(stream_content(store, stream, "id", "text", order_col="seq", checkpoint=str(tmp_path / "c1")))

    def tokenize():
        run(stream_tokens(store, checkpoint=str(tmp_path / "c2")))

    arrive([("a", "one two", 1), ("b", "x", 2)])
    upsert()
    tokenize()
    assert words(store) == {"a": ["one", "two"], "b": ["x"]}
    arrive([("a", "three", 1), ("a", "four", 3), ("c", "y", 2)])
    upsert()
    assert rows_of(store.pending().select("doc_id"), "doc_id") == [(1,), (3,)]
    tokenize()
    assert words(store) == {"a": ["four"], "b": ["x"], "c": ["y"]}
    runs = store.work_table.runs()
    tokenize()
    assert store.work_table.runs() == runs and store.pending().count() == 0


def test_process_wrapper(store, corpus):
    store.register_files(str(corpus))
    store.process(fetch_only=True)
    assert store.tokens().count() == 0
    fn = lambda f: pd.DataFrame({"doc_id": f["doc_id"], "word": f["text"]})
    store.process(k.FrameTokenizer(fn))
    assert words(store)["b.txt"] == ["second\nline"]
    ids = rows_of(store.tokens().select("token_id").distinct())
    assert ids == [(1,)]


def test_derived_by_a_rule_on_lists(spark, store):
    from kotonoha.operators.lists import change_words, filtered_lists

    store.register_content(pairs(spark, [("x", "one 2 three", 1), ("y", "!", 2)]), "id", "text", order_col="seq")
    store.tokenize()
    plain, by_list = store.derive("plain", k.filtered_variant), store.derive("lists", filtered_lists, lists=True)
    assert words(by_list) == words(plain)
    assert by_list.pending().count() == 0 and by_list.problems.count() == 0
    assert rows_of(by_list.tokens(), "doc_id", "token_id") == rows_of(plain.tokens(), "doc_id", "token_id")
    # A list that breaks a rule is its document's error.
    blank = store.derive("blank", lambda r: change_words(r, lambda t: F.when(t["word"] != "one", t["word"])), lists=True)
    errors = {r["doc_id"]: r["error_message"] for r in blank.tokenize_status().collect()}
    assert errors == {1: "null_word", 2: None}
    plan = store.reader().frame._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # lists are read as they are stored
