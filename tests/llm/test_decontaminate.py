import random
from fractions import Fraction

from kotonoha.llm import decontaminate as dc
from tests.llm.helpers import empty_documents, odd_documents, prose


def shingles(text):
    words = dc.words_of(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(docs, items):
    out = []
    for d, text in docs:
        have = shingles(text)
        for k, item in items:
            want = shingles(item)
            if want and Fraction(len(want & have), len(want)) >= Fraction("0.8"):
                out.append((d, k, len(want), len(want & have)))
    return sorted(out)


def search(spark, docs, items):
    found = dc.contained_items(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    return sorted((r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in found.collect())


def cases(seed):
    draw = random.Random(seed)
    small = [f"v{i}" for i in range(12)]
    items = [(k, prose(seed + k, draw.randint(1, 60))) for k in range(25)]
    items += [(50 + k, prose(seed + k, draw.randint(1, 9), small)) for k in range(10)]
    items += [(90, items[0][1]), (91, ""), (92, "v1 v2 v3")]
    docs = []
    for d in range(40):
        parts = [prose(1000 + d, draw.randint(0, 200))]
        for _ in range(draw.randint(0, 3)):
            words = draw.choice(items)[1].split()
            words = words[draw.randint(0, 3) :]
            if words and draw.random() < 0.5:
                words[draw.randrange(len(words))] = "changed"
            parts.append(" ".join(words).upper().replace(" ", ", "))
        parts.append(prose(2000 + d, draw.randint(0, 50), small))
        docs.append((d, " ".join(parts)))
    return docs + [(900, "v1 v2 v3"), (901, "V1, v2.")], items


def test_equals_brute_force(spark):
    for seed in (1, 2):
        docs, items = cases(seed)
        found = search(spark, docs, items)
        assert found == plain(docs, items)
        assert len(found) > 10


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    docs, items = cases(3)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 600)
    assert search(spark, docs, items) == plain(docs, items)
    index = dc.ItemIndex(items, 0.8)
    monkeypatch.setattr(dc, "CHUNK_WORDS", 16)
    found = sorted((d, *hit) for d, text in docs for hit in index.search(dc.words_of(text)))
    assert found == plain(docs, items)


def test_only_minima_are_looked_up_and_candidates_verified():
    items = [(k, prose(k, 40 if k % 2 else 200)) for k in range(60)]
    index = dc.ItemIndex(items, 0.8)
    assert (index.sketch_needed >= 1).all()
    # The tables hold the minima alone, a class for each power of two.
    assert len(index.classes) == 2
    minima = sum(len(c.owners) for c in index.classes)
    assert minima < 0.5 * index.sizes.sum()
    # Without an item in it a document costs its lookups, and no shingle is verified.
    words = dc.words_of(prose(900, 3000))
    assert index.search(words) == [] and index.verified == 0
    # Few shingles of one item do not make it a candidate; the whole item does, alone.
    part = dc.words_of(" ".join(items[4][1].split()[:30]))
    assert index.search(part) == [] and index.verified == 0
    before = index.looked_up
    whole = dc.words_of(items[4][1])
    assert index.search(whole) == [(4, 196, 196)] and index.verified == 196
    assert index.looked_up - before <= len(whole) * len(index.classes)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (None, "a text without an id, and a few"), (3, None), (4, ""), (5, "..."), (6, "Same text in two rows")],
        "item_id long, text string",
    ).selectExpr("*", "1 AS doc_id", "2 AS containment")
    found = dc.contained_items(docs, items)
    assert sorted((r["doc_id"] or -1, r["item_id"] or -1) for r in found.collect()) == [(-1, -1), (1, 1), (5, 6), (5, 6)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contained_items(docs, none).count() == 0
    assert dc.contained_items(empty_documents(spark), items).count() == 0
