"""token_info as VARIANT gives what JSON text gives."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

import kotonoha as k
from kotonoha.functions.words import coarse_pos_from_info
from kotonoha.sources.sinks import read_tokens, write_tokens
from tests.conftest import rows_of

KEYS = ("doc_id", "token_id")


def both(docs, **options):
    return [k.tokenize(docs, variant_info=v, **options) for v in (False, True)]


def test_forms_and_sink_of_the_built_in_tokenizer(spark, tmp_path):
    docs = spark.createDataFrame([(1, 'Das "Haus" \\ 3.5'), (2, None), (3, "東京へ")], "doc_id long, text string")
    text, typed = both(docs)
    assert typed.schema["token_info"].dataType == T.VariantType()
    for form in ("base", "surface", "norm"):
        found, wanted = (k.select_word_form(t, form).select(*KEYS, "word") for t in (typed, text))
        assert rows_of(found, *KEYS) == rows_of(wanted, *KEYS)
    for variant in k.VARIANTS.values():
        found, wanted = (variant(t).select(*KEYS, "word") for t in (typed, text))
        assert rows_of(found, *KEYS) == rows_of(wanted, *KEYS)
    info = [t.select(*KEYS, coarse_pos_from_info(F.col("token_info"), v)) for t, v in ((typed, True), (text, False))]
    assert rows_of(info[0], *KEYS) == rows_of(info[1], *KEYS)
    plan = k.select_word_form(typed, "norm").select(*KEYS, "word")._jdf.queryExecution().optimizedPlan().toString()
    assert "json" not in plan.lower()
    stored = []
    for name, tokens in (("typed", typed), ("text", text)):
        write_tokens(tokens, str(tmp_path / name))
        rows = rows_of(read_tokens(spark, str(tmp_path / name)), *KEYS)
        stored.append([(*r[:4], json.loads(r[4])) for r in rows])
    assert stored[0] == stored[1]


def test_odd_infos_of_other_tokenizers(spark):
    infos = ['{"surface":"X"}', "{broken", None, '{"surface":7}', '["list"]', '{"surface":null}', ""]
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    text, typed = both(docs, tokenizer=lambda _: [(f"w{i}", "p", info) for i, info in enumerate(infos)])
    found, wanted = (k.select_word_form(t, "surface").select(*KEYS, "word") for t in (typed, text))
    assert [r[2] for r in rows_of(found, *KEYS)] == ["X", "w1", "w2", "7", "w4", "w5", "w6"]
    assert rows_of(found, *KEYS) == rows_of(wanted, *KEYS)


def test_variants_read_no_more_than_the_surface(spark):
    from kotonoha.operators.variants import VARIANTS, surface_only

    infos = [None, "", "no json", '{"surface":"Über"}', '{"surface":""}', '{"surface":null}', '{"base_form":"x"}',
             '{"surface":"a\\"b","dictionary_form":"x","normalized_form":"y","pos_detail":["word"]}',
             '{"surface":"w","dictionary_form":"w","normalized_form":"w","pos_detail":["word"]}']
    rows = [
        (i, j, word, pos, info)
        for i, info in enumerate(infos)
        for j, (word, pos) in enumerate([("w", "名詞"), ("3.5", "動詞"), (None, "動詞"), ("über", None), ("-", "補助記号")])
    ]
    tokens = spark.createDataFrame(rows, "doc_id long, token_id int, word string, pos string, token_info string")
    names = ["doc_id", "token_id", "word", "pos"]
    for variant in VARIANTS.values():
        found = variant(surface_only(tokens)).select(*names)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, variant(tokens).select(*names).collect()), key=str)
    same = surface_only(tokens).where("doc_id = 8 AND word = 'w'").first()
    assert same["token_info"] is None
    typed = surface_only(tokens.withColumn("token_info", F.try_parse_json("token_info")))
    assert sorted(map(tuple, typed.collect()), key=str) == sorted(map(tuple, surface_only(tokens).collect()), key=str)


def test_training_variants_leaves_no_copies(spark, tmp_path, monkeypatch):
    from kotonoha.operators import models

    made = []
    monkeypatch.setattr(models, "wide_folder", lambda spark: made.append(str(tmp_path / f"wide-{len(made)}")) or made[-1])
    rows = [(d, i, "ab"[i % 2], "名詞", None) for d in range(4) for i in range(20)]
    tokens = spark.createDataFrame(rows, "doc_id long, token_id int, word string, pos string, token_info string")
    trained = models.train_variants(tokens, vector_size=4, epochs=1, partitions=2)
    assert {n: sorted(r[0] for r in t.vectors.collect()) for n, t in trained.items()} == dict.fromkeys(trained, ["a", "b"])
    assert len(made) == 2 and not any(map(os.path.exists, made))
