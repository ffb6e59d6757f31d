import functools
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kotonoha.llm import align
from tests.llm.helpers import ODD_TEXT, empty_documents, odd_documents, prose

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


@functools.cache
def aligner():
    return align.Aligner(PATH_A, PATH_B)


def tokens_of(text):
    """(id, bytes) of both sides from the libraries themselves."""
    from kotonoha.llm.bpe import symbol_bytes

    a, b = libraries()
    byte_of = symbol_bytes()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    side_a = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in ids_a]
    side_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        side_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return side_a, side_b


def plain_alignment(text):
    """(n_a, n_b, groups text, n_groups, links) token by token."""
    empty = (0, 0, "", 0, [])
    if not text:
        return empty
    sides = tokens_of(text)
    if any(b"".join(b for _, b in s) != (" " + text).encode() for s in sides):
        return empty
    ranges = []
    for side in sides:
        at, found = 0, []
        for i, held in side:
            found.append((at, at + len(held), i))
            at += len(held)
        ranges.append(found)
    ends = sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]})
    groups = []
    for lo, hi in zip([0, *ends], ends, strict=False):
        groups.append("|".join(",".join(str(i) for s, e, i in r if lo <= s and e <= hi) for r in ranges))
    links = [(i, j) for s, e, i in ranges[0] for t, f, j in ranges[1] if s < f and t < e]
    return len(ranges[0]), len(ranges[1]), ";".join(groups), len(groups), links


def plain_rows(texts):
    found = [plain_alignment(t) for t in texts]
    counts = Counter(x for *_, links in found for x in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (a, b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(text.encode()).hexdigest() if text else "")
        for a, b, text, n, links in found
    ]


ODD = [
    "", "a", " ", "   leading", "trailing  ", "\n\n\t x", ODD_TEXT, "<|endoftext|> <s> </s> <unk>", "▁ mark", "a▁b",
    "日本語のテキスト", "\x00\x01", "ﬁ ½ Å é", "\U0001f600\U0001f468‍\U0001f469", "x" * 300, "'s 't 1234567",
    "https://a.b/c?d=e&f", "\r\n", "İı ß", " 　 wide", "</s>",
]


def rows_of(found):
    return (
        found["n_a"], found["n_b"], found["n_groups"], found["n_links"], found["n_best"], found["count_sum"],
        found["groups_sha256"],
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=60, unique=True), st.lists(st.integers(0, 400), max_size=60, unique=True))
def test_gallop_finds_lower_bounds(short, long):
    short = np.sort(np.array(short))
    long = np.sort(np.unique(np.array([*long, int(short[-1])], np.int64)))
    assert align.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_alignment_of_texts(texts):
    found, rows, pairs = aligner().align(texts)
    for i, text in enumerate(texts):
        a, b, groups, n, links = plain_alignment(text)
        assert (found["n_a"][i], found["n_b"][i], found["n_groups"][i], found["n_links"][i]) == (a, b, n, len(links))
        assert found["groups_sha256"][i] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        assert Counter((p >> 32, p & 0xFFFFFFFF) for p in pairs[rows == i].tolist()) == Counter(links)


@pytest.mark.parametrize("block_links", [1, 400, 10**9])
def test_whole_answer(spark, monkeypatch, block_links):
    monkeypatch.setattr(align, "BLOCK_LINKS", block_links)
    texts = ODD + [prose(i, 5 * i) + "." for i in range(25)] + ["Die Straße und der Fluss, été naïve."] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: rows_of(r) for r in align.align_tokenizers(docs, PATH_A, PATH_B).collect()}
    assert found == dict(enumerate(plain_rows(texts)))


def test_parts_of_a_long_text(monkeypatch):
    texts = [prose(3, 400), "a  b   c " * 50, "x" * 500, " " * 300, "one\n two " * 60, "▁ a ▁b" * 40]
    model = aligner()._b
    for characters in (37, 10**6):
        monkeypatch.setattr(align, "PART_CHARACTERS", characters)
        for text in texts:
            parts = [x for part in model._parts(text) for x in model._model.encode(part)]
            assert parts == libraries()[1].encode(text)


def test_words_are_the_text(monkeypatch):
    monkeypatch.setattr(align, "KNOWN_WORDS", 40)
    model = align.PieceEncoder(PATH_B)
    for text in [t for t in ODD if t] + [prose(3, 90), "a\nb c\u2028d é", "lost \u2581 x", "one two  three"]:
        found, plain = model.encode(text), tokens_of(text)[1]
        same = b"".join(b for _, b in plain) == (" " + text).encode()
        assert found.tolist() == [i for i, _ in plain] if same else found is None


def test_ranks_come_back():
    rng = np.random.default_rng(1)
    rows, ranks = rng.integers(0, 7, 500), rng.integers(0, 90, 500)
    held, ends = align.pack_ranks(rows, ranks, 8)
    back = align.unpack_ranks(held, 500)
    for i, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
        assert back[a:b].tolist() == sorted(ranks[rows == i].tolist())


def test_odd_rows(spark):
    docs = odd_documents(spark)
    for name in ("block", "pair", "total", "best", "n_a"):
        docs = docs.selectExpr("*", f"1 AS `{name}`")
    found = align.align_tokenizers(docs, PATH_A, PATH_B).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    short = [(k, t) for k, t in texts if k != 7]
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(k) for k, _ in texts)
    by_id = {r["doc_id"]: r for r in found}
    for key in (2, 3):
        assert rows_of(by_id[key]) == (0, 0, 0, 0, 0, 0, "")
    for key, text in short:
        a, b, _, n, links = plain_alignment(text)
        assert rows_of(by_id[key])[:4] == (a, b, n, len(links))
    assert by_id[7]["n_a"] > 30_000
    assert align.align_tokenizers(empty_documents(spark), PATH_A, PATH_B).count() == 0
