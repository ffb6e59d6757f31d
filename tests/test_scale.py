"""Operators that cut sequential work into slices, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from kotonoha.operators.packing import pack_documents
from kotonoha.plans.layout import size_in_bytes
from kotonoha.plans.numbering import number_rows
from tests.conftest import rows_of


def greedy(sizes, max_chars, max_docs):
    groups, chars, docs, group = [], 0, 0, 0
    for size in sizes:
        if docs and (chars + size > max_chars or docs >= max_docs):
            group, chars, docs = group + 1, 0, 0
        groups.append(group)
        chars, docs = chars + size, docs + 1
    return groups


@pytest.mark.parametrize("max_chars,max_docs", [(100, 5), (30, 50), (10_000, 7), (0, 3), (100, 1), (10**9, 10**6)])
def test_packing_is_the_sequential_walk(spark, max_chars, max_docs):
    rng = random.Random(max_docs)
    sizes = [rng.choice([0, 1, 9, 30, 99, 250]) for _ in range(1500)]
    docs = spark.createDataFrame(
        [(i * 3, s) for i, s in enumerate(sizes)], "doc_id long, char_count int"
    ).repartition(5)
    found = rows_of(pack_documents(docs, max_chars=max_chars, max_docs=max_docs), "doc_id")
    assert [r[2] for r in found] == greedy(sizes, max_chars, max_docs)
    assert [r[1] for r in found] == sizes


def test_packing_by_key_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "b", "c", None]), i, rng.randrange(60)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "lang string, doc_id long, char_count long")
    found = rows_of(pack_documents(docs, max_chars=120, max_docs=6, key_col="lang"))
    for key in ("hot", "b", "c", None):
        mine = sorted((r[1], r[3]) for r in found if r[0] == key)
        wanted = greedy([r[2] for r in rows if r[0] == key], 120, 6)
        assert [g for _, g in mine] == wanted


def test_numbers_follow_the_order(spark):
    values = [f"{random.Random(i).random():.6f}" for i in range(900)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = rows_of(number_rows(df, ["v"], start=10), "row_id")
    assert [r[0] for r in found] == sorted(values)
    assert [r[1] for r in found] == list(range(10, 910))


def test_numbers_within_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 6 + ["x", "y", None]), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, v long").orderBy(F.rand(1))
    found = rows_of(number_rows(df, ["v"], group_cols=["g"], start=1))
    for g in ("hot", "x", "y", None):
        mine = sorted((r[1], r[2]) for r in found if r[0] == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_numbers_of_nothing(spark):
    assert number_rows(spark.createDataFrame([], "v long"), ["v"]).count() == 0


def test_size_settings():
    assert size_in_bytes("134217728b") == size_in_bytes("128m") == size_in_bytes("128MB") == 1 << 27
