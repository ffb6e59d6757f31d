import functools
import itertools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from kotonoha.llm import binpack
from kotonoha.llm.bpe import ByteLevelBpe
from tests.llm.helpers import empty_documents, odd_documents, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@functools.cache
def encoder(specials=True):
    return ByteLevelBpe(PATH, specials)


def reference_ids(text):
    return reference().encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_the_merge_loop_gives_the_tokenizers_ids(text):
    assert encoder().encode(text).tolist() == reference_ids(text)


def test_every_code_point_and_special_tokens():
    points = [*range(0x3400), *range(0x3400, 0x110000, 53)]
    for c in (chr(p) for p in points if not 0xD800 <= p < 0xE000):
        text = f"a{c}b {c}1{c}2  {c} {c}{c}\n{c}.{c} x"
        assert encoder().encode(text).tolist() == reference_ids(text)
    for text in ("x <|endoftext|> y<|endoftext|>", "<|endoftext|>", " \n<|endoftext|>\n  a", "it's we'll  ", "a" * 50_000):
        assert encoder().encode(text).tolist() == reference_ids(text)
    assert 50256 not in encoder(False).encode("<|endoftext|>")


def most_pairs(items, capacity):
    """The largest number of pairs that fit, by trying all."""
    if not items:
        return 0
    first, rest = items[0], items[1:]
    best = most_pairs(rest, capacity)
    for i, other in enumerate(rest):
        if first + other <= capacity:
            best = max(best, 1 + most_pairs(rest[:i] + rest[i + 1 :], capacity))
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(8, 22), max_size=7))
def test_matching_has_the_most_pairs(items):
    found = binpack.matched_pairs(Counter(items), 22)
    assert sum(n for sizes, n in found if len(sizes) == 2) == most_pairs(items, 22)
    assert sorted(s for sizes, n in found for s in sizes * n) == sorted(items)


def one_by_one(items, capacity):
    """Bins of matching and best fit with every item and bin by itself."""
    bins = [list(sizes) for sizes, n in binpack.matched_pairs(Counter(items), capacity) for _ in range(n)]
    for size in sorted((s for s in items if 3 * s <= capacity), reverse=True):
        room = [b for b in bins if sum(b) + size <= capacity]
        if room:
            max(room, key=sum).append(size)
        else:
            bins.append([size])
    return Counter(tuple(sorted(b)) for b in bins)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_groups_of_bins_are_the_bins_of_single_items(items):
    plan = binpack.plan_bins(Counter(items), 30)
    found = [[s for s, n in held for _ in range(n)] for held, bins in plan for _ in range(bins)]
    assert Counter(s for b in found for s in b) == Counter(items)
    assert all(sum(b) <= 30 for b in found)
    # Which of two bins with the same room takes an item is open, the rooms left are not.
    assert sorted(map(sum, found)) == sorted(sum(b) for b, n in one_by_one(items, 30).items() for _ in range(n))


def test_the_plan_does_not_grow_with_the_counts():
    rng = np.random.default_rng(3)
    counts = {s: int(n) for s, n in zip(range(1, 1025), rng.integers(1, 10**9, 1024), strict=True)}
    plan = binpack.plan_bins(counts, 1024)
    tokens = sum(s * n for s, n in counts.items())
    assert len(plan) < 3000
    assert sum(n for _, n in plan) * 1024 < 1.35 * tokens
    small = {s: n for s, n in counts.items() if s <= 600}
    bins = sum(n for _, n in binpack.plan_bins(small, 1024))
    assert bins * 1024 < 1.001 * sum(s * n for s, n in small.items())


def test_pieces():
    assert binpack.cut_pieces(1, 4) == [(0, 1)]
    assert binpack.cut_pieces(8, 4) == [(0, 4), (4, 4)]
    assert binpack.cut_pieces(9, 4) == [(0, 1), (1, 4), (5, 4)]


def check(rows, ids_of, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for some in by_sequence.values():
        some.sort(key=lambda r: r["offset"])
        ends = list(itertools.accumulate((r["length"] for r in some), initial=0))
        assert [r["offset"] for r in some] == ends[:-1] and ends[-1] <= capacity
    for key, ids in ids_of.items():
        some = sorted((r for r in rows if r["doc_id"] == key), key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in some] == binpack.cut_pieces(len(ids), capacity)
        assert [r["piece"] for r in some] == list(range(len(some)))
        for r in some:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_whole_answer(spark):
    texts = {i: prose(i, i * i % 97) for i in range(150)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = binpack.pack_best_fit(docs, PATH, capacity=64).collect()
    ids = {k: [*reference_ids(t), 2] for k, t in texts.items()}
    items = [n for v in ids.values() for _, n in binpack.cut_pieces(len(v), 64)]
    assert check(rows, ids, 64) == sum(one_by_one(items, 64).values())


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumnRenamed("_id", "_split")
    rows = binpack.pack_best_fit(docs, PATH).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    for key in (2, 3):
        (r,) = [r for r in rows if r["doc_id"] == key]
        assert (r["length"], r["ids_crc32"]) == (1, zlib.crc32(b"\x02\0\0\0"))
    assert len([r for r in rows if r["doc_id"] == 5]) == 2
    check(rows, {7: [*reference_ids("long " * 30_000 + "end."), 2]}, binpack.CAPACITY)
    assert binpack.pack_best_fit(empty_documents(spark), PATH).count() == 0
