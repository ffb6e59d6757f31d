"""Registered queries against their SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.parity import compare, duck

FOLDER = "/root/testdata/sf0.001"
CHOSEN = [
    "tokenize", "split_text", "stopwords_union", "variant_hybrid", "derived_table", "tfidf", "ngram2",
    "ngram_null_words", "edges_merged", "pending", "select_updates", "pack_by_lang", "knn", "analogy",
    "model_compare", "doc_vectors",
]


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    found = queries()[name](spark, FOLDER).toPandas()
    assert compare(found, con.execute(oracle_sql()[name]).fetchdf()) == "ok"


def test_registry():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 20
