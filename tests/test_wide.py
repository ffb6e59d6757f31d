"""Wide rows: small row groups, and no list of rows without a document."""

import glob
import json
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

import kotonoha as k
from kotonoha.operators.reader import collect_known
from kotonoha.plans import layout
from kotonoha.plans import store as store_module
from kotonoha.plans.store import CorpusStore
from tests.conftest import rows_of

SCHEMA = "doc_id long, token_id int, word string, pos string, token_info string"


def test_rows_of_no_document_are_counted_not_collected(spark):
    rows = [(d, i, "w", "word", None) for d in (None, -1, 1) for i in range(50)]
    docs = spark.createDataFrame([(1,), (2,), (None,), (1,)], "doc_id long")
    found = collect_known(spark.createDataFrame(rows, SCHEMA), docs)
    sizes = found.select("doc_id", F.size("tokens"), "known", "n").collect()
    assert sorted(map(tuple, sizes), key=str) == [(-1, 0, False, 50), (1, 50, True, 50), (None, 0, False, 50)]


def test_wide_rows_lie_in_small_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "ROW_GROUP_BYTES", 64 << 10)
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2((F.col("id") * i).cast("string"), 256)))
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), text.alias("text")).coalesce(1)
    store = CorpusStore(spark, str(tmp_path))
    store.register_content(docs, "doc_id", "text", order_col="doc_id")
    store.tokenize()
    for table in ("fetch", "works/main"):
        files = glob.glob(f"{tmp_path}/{table}/gen=0/run_id=*/*.parquet")
        assert sum(pq.ParquetFile(f).num_row_groups for f in files) >= 2 * len(files)
    assert store.token_lists().count() == 1200
    assert rows_of(layout.fix_wide(docs), "doc_id") == rows_of(docs, "doc_id")


def test_token_info_is_stored_packed_and_read_whole(spark, tmp_path):
    """What the script tokenizer writes takes a mark in the store; every other text comes back too."""
    info = '{"surface":"Ab","dictionary_form":"Ab","normalized_form":"ab","pos_detail":["word"]}'
    odd = [("Ab", "word", info), ("ab", "word", info), ("x", "word", "\x00"), ("x", None, "\x00\x00y"), ("x", "word", None), (None, "word", info)]
    tokenizer = k.TextTokenizer(lambda: lambda text: [t for t in odd if t[0]] if text == "odd" else [])
    store = CorpusStore(spark, str(tmp_path))
    docs = spark.createDataFrame([(1, "odd"), (2, "Das \"Haus\" 3.")], "doc_id long, text string")
    store.register_content(docs, "doc_id", "text", order_col="doc_id")
    store.tokenize(tokenizer)
    listed = [(*t,) for t in odd if t[0]]
    assert [tuple(t)[1:] for t in store.token_lists().where("doc_id = 1").first()["tokens"]] == listed
    store.tokenize(doc_ids=[2])
    whole = rows_of(k.tokenize(docs.where("doc_id = 2")), "doc_id", "token_id")
    names = ["doc_id", "token_id", "word", "pos", "token_info"]
    assert rows_of(store.tokens().where("doc_id = 2").select(*names), "token_id") == whole
    kept = store.work_table.read().where("event = 'done' AND doc_id = 2 AND size(tokens) > 0").first()["tokens"]
    assert {t["token_info"] for t in kept} == {"\x00"}
    for options in ({}, {"lists": True}):
        derived = store.derive("again", lambda t: t, **options)
        assert rows_of(derived.tokens().select(*names), "doc_id", "token_id") == rows_of(store.tokens().select(*names), "doc_id", "token_id")
        assert derived.problems.count() == 0


def test_copies_made_on_the_way_are_removed(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(store_module, "wide_folder", lambda spark: made.append(str(tmp_path / f"wide-{len(made)}")) or made[-1])
    store = CorpusStore(spark, str(tmp_path / "store"))
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    store.register_content(docs, "doc_id", "text", order_col="doc_id")
    store.tokenize()
    moved = F.when(F.col("word") == "b", F.lit(-1)).otherwise(F.col("doc_id"))
    derived = store.derive("moved", lambda t: t.withColumn("doc_id", moved))
    assert len(made) == 2 and not any(map(os.path.exists, made))
    assert rows_of(derived.problems) == [(-1, "foreign_doc", 1)]
    assert rows_of(derived.word_lists(), "doc_id") == [(1, ["a"]), (2, ["c"])]


def test_info_of_every_symbol_is_json(spark):
    chars = [chr(i) for i in [*range(33, 256), 0x2028, 0x3001, 0x1F600]]
    docs = spark.createDataFrame(list(enumerate(chars)), "doc_id long, text string")
    rows = k.tokenize(docs).where("pos = 'symbol'").select("word", "token_info").collect()
    assert {r["word"] for r in rows} >= set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    for word, info in rows:
        assert info == json.dumps(
            {"surface": word, "dictionary_form": word, "normalized_form": word.lower(), "pos_detail": ["symbol"]},
            ensure_ascii=False, separators=(",", ":"),
        ), word
