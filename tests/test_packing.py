"""Size-bounded groups: composed reports give what one sequential walk gives."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kotonoha.operators import packing


def walk(sizes, max_chars, max_docs):
    """Group of every document, one after the other."""
    groups, group, docs, chars = [], 0, 0, 0
    for size in sizes:
        if docs and (chars + size > max_chars or docs == max_docs):
            group, docs, chars = group + 1, 0, 0
        groups.append(group)
        docs, chars = docs + 1, chars + size
    return groups


SIZES = st.lists(st.integers(0, 12), min_size=1, max_size=14)


@settings(max_examples=400, deadline=None)
@given(SIZES, SIZES, st.integers(1, 20), st.integers(1, 5))
def test_composed_reports_are_the_report_of_both(first, second, max_chars, max_docs):
    one, two = (packing._report(np.array(s), max_chars, max_docs) for s in (first, second))
    both = packing._report(np.array(first + second), max_chars, max_docs)
    found = packing._composed(one, two, max_chars, max_docs)
    for name, value in both.items():
        assert np.array_equal(found[name], value), name


@settings(max_examples=300, deadline=None)
@given(st.lists(SIZES, min_size=1, max_size=6), st.integers(1, 20), st.integers(1, 5))
def test_steps_arrive_where_the_walk_is(slices, max_chars, max_docs):
    sizes = [s for part in slices for s in part]
    groups = walk(sizes, max_chars, max_docs)
    state, at = (0, 0, 0), 0
    for part in slices:
        report = packing._report(np.array(part), max_chars, max_docs)
        state = packing._step(report, *state, max_chars, max_docs)
        at += len(part)
        mine = [i for i in range(at) if groups[i] == groups[at - 1]]
        assert state == (len(mine), sum(sizes[i] for i in mine), groups[at - 1])


def test_starts_without_a_loop():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 300):
        following = np.minimum(np.arange(n) + rng.integers(1, 6, n), n)
        for place in {0, n // 2, n - 1}:
            want, i = np.zeros(n, int), place
            while i < n:
                want[i], i = 1, following[i]
            assert packing._reached(following, place).tolist() == want.tolist()


@pytest.mark.parametrize("block", [2, 64])
def test_a_hot_key_over_many_slices(spark, monkeypatch, block):
    """One key in 200 slices, others beside it; blocks of reports meet over several levels."""
    monkeypatch.setattr(packing, "BLOCK_REPORTS", block)
    rng = np.random.default_rng(3)
    n = 1200
    sizes = rng.integers(0, 40, n).tolist()
    keys = ["hot" if i % 12 else (None if i % 24 else "cold") for i in range(n)]
    docs = spark.createDataFrame(list(zip(range(n), sizes, keys, strict=True)), "doc_id long, char_count long, k string")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "40" if block == 2 else "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = packing.pack_documents(docs, max_chars=100, max_docs=7, key_col="k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    for key in ("hot", "cold", None):
        rows = sorted((r["doc_id"], r["char_count"], r["group_id"]) for r in found if r["k"] == key)
        assert [g for _, _, g in rows] == walk([s for _, s, _ in rows], 100, 7)
    assert len(found) == n
