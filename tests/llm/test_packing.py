import functools
import itertools
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from kotonoha.llm import packing
from tests.llm.helpers import empty_documents, odd_documents, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@functools.cache
def shared_encoder():
    return packing.ChunkEncoder(PATH)


def reference_ids(texts):
    return [e.ids for e in reference().encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_chunks_give_the_tokenizers_ids(texts):
    encoder = shared_encoder()
    assert [encoder.encode(t)[0].tolist() for t in texts if t] == reference_ids([t for t in texts if t])


def test_hard_chunks():
    texts = [
        "it's don't 'tis o'neil's", "<|startoftext|>x <|endoftext|>", "ΟΔΥΣΣΕΥΣ Σ İstanbul", "é É.", "a b c d\x1ce",
        "...!? --- (a). [b], c;", "3.14 1,000 x2y", "STRASSE ẞ ﬁ", "\t\r\n \n\n", "word_with_under-score's.",
    ]
    encoder = packing.ChunkEncoder(PATH)
    for _ in range(2):  # the second time from memory
        assert [encoder.encode(t)[0].tolist() for t in texts] == reference_ids(texts)


def test_many_code_points_together():
    """Every settled letter, and unassigned ones, in several surroundings."""
    points = [*range(0x3000), *range(0x3000, 0x110000, 61)]
    chars = [chr(c) for c in points if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c}2  {c} {c}{c}\n{c}.{c} x'{c} E{c}" for c in chars]
    found = packing.ChunkEncoder(PATH).encode_many(["", *texts])
    assert [ids.tolist() for ids, _ in found] == [[], *reference_ids(texts)]


def test_texts_of_a_group_stay_apart():
    texts = ["one. two", "", "three\nfour. five ", ".", "six"]
    encoder = packing.ChunkEncoder(PATH)
    together = encoder.encode_many(texts)
    for text, (ids, stops) in zip(texts, together, strict=True):
        alone, alone_stops = packing.ChunkEncoder(PATH).encode(text)
        assert ids.tolist() == alone.tolist() and stops == alone_stops
    groups = list(packing.groups_of_texts(["ab", None, "c", "defgh", ""], 3))
    assert groups == [["ab", "", "c"], ["defgh"], [""]]


def test_cache_is_emptied(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 5)
    encoder = packing.ChunkEncoder(PATH)
    texts = [prose(i, 20) for i in range(6)]
    assert [encoder.encode(t)[0].tolist() for t in texts] == reference_ids(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 7), st.sampled_from([0, 1, 2])), min_size=1, max_size=9), st.integers(0, 5))
def test_cuts_are_the_cheapest(steps, penalty):
    window = 8
    ends = list(itertools.accumulate(s for s, _ in steps))
    kinds = [k for _, k in steps]
    price = {0: 0, 1: penalty, 2: 2 * penalty}

    def cost(chosen):
        places = [0, *[ends[i] for i in chosen]]
        gaps = np.diff(places)
        return None if (gaps > window).any() else sum(window - gaps) + sum(price[kinds[i]] for i in chosen)

    last = len(ends) - 1
    every = [
        cost([*some, last]) for n in range(last + 1) for some in itertools.combinations(range(last), n)
    ]
    assert cost(packing.best_cuts(ends, kinds, window, penalty)) == min(c for c in every if c is not None)


def check_pieces(rows, ids_of, window=packing.WINDOW):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for some in by_sequence.values():
        some.sort(key=lambda r: r["offset"])
        at = 0
        for r in some:
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    for key, ids in ids_of.items():
        some = sorted(by_doc[key], key=lambda r: r["start"])
        at = 0
        for r in some:
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)
    return by_sequence


def test_every_id_in_one_piece(spark):
    texts = {i: ". ".join(prose(100 * i + k, 12) for k in range(i % 23)) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(2)
    rows = packing.pack_documents(docs, PATH).collect()
    ids = {k: [*reference_ids([t])[0], 1] for k, t in texts.items()}
    sequences = check_pieces(rows, ids)
    full = sum(map(len, ids.values()))
    assert len(sequences) * packing.WINDOW - full < 0.1 * full + 2 * packing.WINDOW


def test_blocks_leave_no_seam(spark, monkeypatch):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 40, 300).tolist()

    def packed(block):
        monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
        packer = packing._Packer(32, 3, 0)
        out = []
        for key, n in enumerate(sizes):
            out += packer.add(key, np.arange(n, dtype=np.uint32), list(range(5, n, 5)))
        return out + list(packer.flush())

    waste = {}
    for block in (1024, 2048, 10**9):
        out = packed(block)
        assert sum(r[2] for r in out) == sum(sizes)
        waste[block] = 32 * len({r[5] for r in out}) - sum(sizes)
    assert max(waste.values()) < 1.2 * waste[10**9]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = packing.pack_documents(docs, PATH).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == {1, 2, 3, 4, 5, 6, 7, 8, None}
    for key in (2, 3, 4):
        (r,) = by_doc[key]
        assert (r["length"], r["doc_tokens"], r["ids_crc32"]) == (1, 1, zlib.crc32(b"\x01\0\0\0"))
    assert sum(r["length"] for r in by_doc[5]) == 2 * by_doc[5][0]["doc_tokens"]
    assert packing.pack_documents(empty_documents(spark), PATH).count() == 0
