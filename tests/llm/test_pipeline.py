"""The pipeline against plain Python on a small corpus, and the queries against their SQL."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm import test_decontaminate, test_lines, test_simhash
from tests.llm.helpers import SCHEMA, empty_documents, odd_documents, prose
from tools.parity import compare, duck

FOLDER = "/root/testdata/sf0.001"
NAMES = [n for n in queries() if n.startswith("op")]


def rows_of(docs):
    return sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))


def test_all_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in NAMES] == list(range(1, 14))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    found = queries()[name](spark, FOLDER)
    sql = oracle_sql().get(name)
    if sql:
        assert compare(found.toPandas(), duck(FOLDER).execute(sql).fetchdf()) == "ok"
    else:
        table, key = {"op9": ("pages", "page_id"), "op11": ("embeddings", "vec_id")}.get(
            name.split("_")[0], ("documents", "doc_id")
        )
        wanted = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).distinct()
        assert found.select(key).distinct().exceptAll(wanted).count() == 0
        assert wanted.exceptAll(found.select(key).distinct()).count() == 0


def corpus(spark, folder):
    item = prose(900, 30)
    rows = []
    for i in range(60):
        text = prose(i, 90)
        if i % 4 == 0:
            text += "\nShared line of many documents"
        if i % 10 == 3:
            text += "\n" + item
        if i % 15 == 7:
            text = prose(i - 1, 90).replace("w1", "w2", 1)
        rows.append((i, text, "en", "s", len(text)))
    docs = odd_documents(spark, [(100 + r[0], *r[1:]) for r in rows], clashes=False)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_equal_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    first = stage["language_id"](spark, docs, folder)
    assert first.schema == docs.schema
    lettered = [r for r in rows_of(docs) if any(c.isalpha() for c in r["text"] or "")]
    assert [tuple(r) for r in rows_of(first)] == [tuple(r) for r in lettered]

    second = stage["line_dedup"](spark, first, folder)
    pairs = [(r["doc_id"], r["text"]) for r in lettered]
    wanted = {(k, h) for k, _, _, h in test_lines.plain(pairs, 10)}
    import hashlib

    assert {(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in second.collect()} == wanted
    assert second.columns == docs.columns

    third = stage["simhash_dedup"](spark, second, folder)
    rows = rows_of(second)
    labels = test_simhash.plain_components([test_simhash.plain_fingerprint(r["text"]) for r in rows])
    assert [tuple(r) for r in rows_of(third)] == [tuple(rows[i]) for i in sorted(set(labels))]

    fourth = stage["decontamination"](spark, third, folder)
    items = [(1, prose(900, 30)), (2, None)]
    rows = rows_of(third)
    bad = {d for d, *_ in test_decontaminate.plain([(r["doc_id"] or -1, r["text"]) for r in rows], items)}
    assert [tuple(r) for r in rows_of(fourth)] == [tuple(r) for r in rows if (r["doc_id"] or -1) not in bad]
    assert bad

    last = stage["packing"](spark, fourth, folder)
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in fourth.collect()}
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() == fourth.select("doc_id").distinct().count()


def test_empty_corpus(spark, tmp_path):
    empty_documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert SCHEMA
