"""Tokenizers that hang, die or fail: their documents are marked, the others go on."""

import os
import time

import pandas as pd
import pytest

import kotonoha as k
from kotonoha.operators.frames import run_spans
from kotonoha.operators.isolation import Isolated
from kotonoha.operators.tokenize import tokenize_lists

TEXTS = {1: "a b", 2: "hang", 3: "c", 4: "die", 5: "raise", 6: "d e", 7: "", 8: None}


def words(text):
    print("noise on the way")  # must not be taken for an answer
    if "hang" in text:
        time.sleep(600)
    if "die" in text:
        os._exit(3)
    if "raise" in text:
        raise ValueError("refused")
    return [(w, "w", None) for w in text.split()]


def frame_words(frame):
    rows = [(d, *w) for d, t in zip(frame["doc_id"], frame["text"], strict=True) for w in words(t or "")]
    return pd.DataFrame(rows, columns=["doc_id", "word", "pos", "token_info"])


def module_functions():
    """The functions by value: the workers do not have this module."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.mark.parametrize("kind", ["text", "frame"])
def test_hanging_and_dying_tokenizers(spark, kind):
    module_functions()
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").coalesce(1)
    tokenizer = k.text_tokenizer(words, time_limit=3) if kind == "text" else k.FrameTokenizer(frame_words, time_limit=3)
    begin = time.time()
    rows = {r["doc_id"]: r for r in tokenize_lists(docs, tokenizer).collect()}
    assert time.time() - begin < 100
    assert {d for d, r in rows.items() if r["error"]} == {2, 4, 5}
    assert "no result within 3 seconds" in rows[2]["error"]
    assert "ended with code 3" in rows[4]["error"] and "refused" in rows[5]["error"]
    assert {d: [t["word"] for t in r["tokens"]] for d, r in rows.items() if not r["error"]} == {
        1: ["a", "b"], 3: ["c"], 6: ["d", "e"], 7: [], 8: [],
    }


def test_a_function_that_cannot_be_built():
    def broken():
        raise KeyError("no dictionary")

    with pytest.raises(RuntimeError, match="no dictionary"):
        Isolated(broken, 5)("x")


def test_a_failing_batch_is_halved():
    calls = []

    def attempt(places):
        calls.append(list(places))
        if {37, 200} & set(places):
            raise ValueError("bad")
        import numpy as np
        import pyarrow as pa

        from kotonoha.operators.frames import TOKEN_FIELDS

        return np.array(places), [pa.array([None] * len(places), f.type) for f in TOKEN_FIELDS], {}

    owners, _, errors = run_spans([(0, 256)], attempt)
    assert set(errors) == {37, 200} and owners.tolist() == [i for i in range(256) if i not in (37, 200)]
    assert len(calls) < 40


def test_arrow_tokenizers(spark):
    import pyarrow as pa
    import pyarrow.compute as pc

    def build():
        def lists(texts):
            if "bad" in "".join(texts.to_pylist()):
                raise ValueError("refused")
            words = pc.split_pattern(texts, " ")
            tokens = pa.StructArray.from_arrays([words.flatten()], ["word"])
            return pa.ListArray.from_arrays(pc.subtract(words.offsets, words.offsets[0]), tokens)

        return lists

    rows = [(1, "a b"), (2, "bad"), (3, " c "), (4, "d\U0001f600 e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r for r in tokenize_lists(docs, k.ArrowTokenizer(build)).collect()}
    assert "refused" in found[2]["error"] and found[2]["tokens"] is None
    assert {d: [(t["token_id"], t["word"], t["pos"]) for t in found[d]["tokens"]] for d in (1, 3, 4)} == {
        1: [(0, "a", None), (1, "b", None)], 3: [(0, "c", None)],
        4: [(0, "d\U0001f600", None), (1, "e", None), (2, "f", None)],
    }

    def short():
        return lambda texts: pa.array([[]], pa.list_(pa.struct([("word", pa.string())]))).slice(0, 0)

    assert all("one list for every text" in r["error"] for r in tokenize_lists(docs, k.ArrowTokenizer(short)).collect())
