import json
import re

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import kotonoha as k
from kotonoha.functions.text import cut_points, has_content, is_noise, mask_numbers, strip_text
from kotonoha.functions.words import plain_pattern, script_words
from kotonoha.operators import filters as filter_module
from tests.conftest import rows_of


def _split(text):
    return [(word, "word", None) for word in text.split()]


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")


def test_script_tokens_and_positions(spark):
    docs = docs_of(spark, "今日は良い天気です。ABC 12.5", None, "  　\n", "")
    found = rows_of(k.tokenize(docs).drop("token_info"), "doc_id", "token_id")
    assert [r[2] for r in found] == ["今日", "は", "良", "い", "天気", "です", "。", "ABC", "12.5"]
    assert [r[1] for r in found] == list(range(9))
    assert {r[0] for r in found} == {1}
    assert [r[3] for r in found][-3:] == ["symbol", "word", "number"]


def test_positions_are_counted_before_the_filter(spark):
    docs = docs_of(spark, "a , b 7 c")
    found = rows_of(k.tokenize(docs, pos_keep="word", stopwords="b"), "token_id")
    assert [(r[1], r[2]) for r in found] == [(0, "a"), (4, "c")]


def test_token_info_is_json_and_optional(spark):
    docs = docs_of(spark, 'Ab "')
    infos = [json.loads(r[0]) for r in rows_of(k.tokenize(docs).select("token_info"))]
    assert infos[0] == {
        "surface": "Ab", "dictionary_form": "Ab", "normalized_form": "ab", "pos_detail": ["word"],
    }
    assert infos[1]["surface"] == '"'
    assert k.tokenize(docs, info_col=None).columns == ["doc_id", "token_id", "word", "pos"]


def test_argument_errors(spark):
    docs = docs_of(spark, "a")
    with pytest.raises(KeyError):
        k.tokenize(docs, id_col="id")
    with pytest.raises(KeyError):
        k.tokenize(docs, text_col="body")
    with pytest.raises(ValueError):
        k.tokenize(docs, word_form="weird")


def test_passed_function(spark):
    docs = docs_of(spark, " x y ", None, "z")
    fn = lambda t: [(w, "p", {"surface": w.upper(), "漢": 1}) for w in t.split(" ")]
    found = rows_of(k.tokenize(docs, tokenizer=fn), "doc_id", "token_id")
    assert [r[:4] for r in found] == [(1, 0, "x", "p"), (1, 1, "y", "p"), (3, 0, "z", "p")]
    assert found[0][4] == '{"surface": "X", "漢": 1}'
    upper = rows_of(k.select_word_form(k.tokenize(docs, tokenizer=fn), "orig"), "doc_id", "token_id")
    assert [r[2] for r in upper] == ["X", "Y", "Z"]


def test_failing_document_is_isolated(spark):
    def fn(text):
        if "bad" in text:
            raise RuntimeError("no")
        return [(text, None, None)]

    lists = k.tokenize_lists(docs_of(spark, "ok", "bad", "fine"), k.text_tokenizer(fn))
    found = {r["doc_id"]: r for r in lists.collect()}
    assert found[2]["tokens"] is None and "RuntimeError: no" in found[2]["error"]
    assert found[1]["error"] is None and found[3]["tokens"][0]["word"] == "fine"


def frame_cases(frame):
    out = []
    for d, t in zip(frame["doc_id"], frame["text"]):
        if t == "raise":
            raise ValueError("refused")
        if t == "foreign":
            out.append((99, 1, "w"))
        elif t == "twice":
            out += [(d, 1, "w"), (d, 1, "v")]
        elif t == "hole":
            out.append((d, None, "w"))
        elif t:
            out += [(d, i, w) for i, w in enumerate(t.split(), 5)]
    return pd.DataFrame(out, columns=["doc_id", "token_id", "word"])


def test_frame_contract_per_document(spark):
    docs = docs_of(spark, "a b", "raise", "foreign", "twice", "hole", "", "c")
    lists = k.tokenize_lists(docs, k.FrameTokenizer(frame_cases, max_docs=3), carry=("text",))
    found = {r["doc_id"]: r for r in lists.collect()}
    assert [(t["token_id"], t["word"], t["pos"]) for t in found[1]["tokens"]] == [
        (5, "a", None), (6, "b", None),
    ]
    for doc, text in ((2, "refused"), (3, "outside"), (4, "repeats"), (5, "NULL token_id")):
        assert found[doc]["tokens"] is None and text in found[doc]["error"]
    assert found[6]["tokens"] == [] and found[6]["error"] is None
    assert found[7]["tokens"][0]["word"] == "c" and found[7]["text"] == "c"


def test_frame_fills_positions_from_one(spark):
    fn = lambda f: pd.DataFrame(
        [(d, w) for d, t in zip(f.doc_id, f.text) for w in t.split()], columns=["doc_id", "word"]
    )
    lists = k.tokenize_lists(docs_of(spark, "a b", "c"), k.FrameTokenizer(fn))
    found = {r["doc_id"]: [(t["token_id"], t["word"]) for t in r["tokens"]] for r in lists.collect()}
    assert found == {1: [(1, "a"), (2, "b")], 2: [(1, "c")]}


def pieces(text, size):
    ends = list(cut_points(text, size))
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def test_split_prefers_line_then_stop_then_comma_then_cuts():
    assert pieces("x" * 95 + "。" + "y" + "\n" + "z" * 20, 100) == ["x" * 95 + "。y\n", "z" * 20]
    assert pieces("x" * 92 + "、" + "y" * 4 + "。" + "z" * 20, 100)[0].endswith("。")
    assert pieces("x" * 50 + "\n" + "x" * 100, 100)[0] == "x" * 50 + "\n" + "x" * 49
    assert pieces("x" * 100, 100) == ["x" * 100]
    assert pieces("", 100) == []


def test_split_text_gives_the_text_back(spark):
    text = ("語" * 37 + "。" + "x" * 11 + "\n") * 60
    chunks = rows_of(k.split_text(docs_of(spark, text, "", None), max_length=100), "chunk_id")
    assert "".join(c[2] for c in chunks) == text
    assert max(len(c[2]) for c in chunks) <= 100
    assert [c[1] for c in chunks] == list(range(len(chunks)))


def test_strip_and_blank(spark):
    df = spark.createDataFrame(
        [(1, "　\n a b\x1f\xa0"), (2, "  　"), (3, None)], "i int, t string"
    ).select("i", strip_text(F.col("t")).alias("s"), has_content(F.col("t")).alias("h"))
    assert rows_of(df, "i") == [(1, "a b", True), (2, "", False), (3, None, False)]


def test_number_mask_and_noise(spark):
    words = ["12", "１２", "1.5", "1.", "a1", "!?", "あ", "ああ", "[NUM]", None]
    df = spark.createDataFrame(list(enumerate(words)), "i int, w string")
    found = rows_of(df.select("i", mask_numbers(F.col("w")), is_noise(F.col("w"))), "i")
    assert [r[1] for r in found] == ["[NUM]", "[NUM]", "[NUM]", "1.", "a1", "!?", "あ", "ああ", "[NUM]", None]
    assert [r[2] for r in found] == [False] * 5 + [True, True, False, False, False]


# -- filters -----------------------------------------------------------------

ROWS = [(1, 0, "a", "n"), (1, 1, "b", "v"), (1, 2, None, "n"), (1, 3, "c", None), (2, 0, "a", "x")]


def words_left(df):
    return [(r[0], r[1]) for r in rows_of(df, "doc_id", "token_id")]


def test_null_rules_of_filters(tokens):
    table = tokens(ROWS)
    assert words_left(k.filter_tokens(table, pos_keep=["n", "x"])) == [(1, 0), (1, 2), (2, 0)]
    assert words_left(k.filter_tokens(table, pos_exclude="n")) == [(1, 1), (1, 3), (2, 0)]
    assert words_left(k.filter_tokens(table, stopwords=["a"])) == [(1, 1), (1, 2), (1, 3)]
    assert words_left(k.filter_tokens(table, pos_keep=[], stopwords=[])) == words_left(table)


def test_filter_is_idempotent_and_warns(tokens):
    table = tokens(ROWS)
    once = k.filter_tokens(table, pos_exclude="n", stopwords="b")
    assert words_left(k.filter_tokens(once, pos_exclude="n", stopwords="b")) == words_left(once)
    with pytest.warns(UserWarning):
        k.filter_tokens(table, pos_keep="n", pos_exclude="v")
    with pytest.raises(KeyError):
        k.filter_tokens(table.drop("pos"))
    with pytest.raises(KeyError):
        k.filter_tokens(table.drop("word"), stopwords="a")


@pytest.mark.parametrize("limit", [2_000, 0])
def test_stopword_sources(spark, tokens, monkeypatch, limit):
    monkeypatch.setattr(filter_module, "LITERAL_STOPWORDS", limit)
    table = tokens(ROWS)
    for source in ("a", ["a"], {"a": 5}, pd.Series([3], index=["a"]), [["a"], ("a",)], [pd.Index(["a"])]):
        assert words_left(k.filter_tokens(table, stopwords=source)) == [(1, 1), (1, 2), (1, 3)]
    frame = spark.createDataFrame([("a", 3), ("c", 1)], "word string, count long")
    assert words_left(k.filter_tokens(table, stopwords=[frame, "b"])) == [(1, 2)]
    assert rows_of(k.stopword_table(spark, [frame, ["c", {7}]]), "word") == [("7",), ("a",), ("c",)]


@pytest.mark.parametrize("limit", [2_000, 0])
def test_frequent_words_drop_out(tokens, monkeypatch, limit):
    monkeypatch.setattr(filter_module, "LITERAL_STOPWORDS", limit)
    left = k.drop_frequent_words(tokens(ROWS), 1)
    assert words_left(left) == [(1, 1), (1, 2), (1, 3)]


# -- variants --------------------------------------------------------------------


def test_variants_on_japanese_tokens(spark):
    info = lambda s: json.dumps({"surface": s}, ensure_ascii=False)
    rows = [
        (1, 0, "為る", "動詞", info("し")),
        (1, 1, "２０", "名詞", info("20")),
        (1, 2, "。", "補助記号", info("。")),
        (1, 3, "は", "助詞", info("は")),
        (1, 4, " ", "空白", None),
        (1, 5, "??", "名詞", "broken"),
        (1, 6, "ああ", "感動詞", info("あー")),
        (1, 7, "検討", "名詞", info("検討")),
        (1, 8, "無い", None, info("ない")),
    ]
    table = spark.createDataFrame(
        rows, "doc_id long, token_id int, word string, pos string, token_info string"
    )
    words = {n: [r[2] for r in rows_of(v(table), "token_id")] for n, v in k.VARIANTS.items()}
    assert words["filtered"] == ["為る", "[NUM]", "ああ", "検討", "無い"]
    assert words["surface"] == ["し", "20", "。", "は", "??", "あー", "検討", "ない"]
    assert words["hybrid"] == ["し", "[NUM]", "は", "??", "検討", "ない"]
    assert [r[1] for r in rows_of(k.filtered_variant(table), "token_id")] == [0, 1, 6, 7, 8]


# -- back to text and lists -------------------------------------------------------


def test_text_and_lists_over_blocks(spark, tokens):
    rows = [(d, i, f"w{i}" if i % 5 else None, "n") for d in (1, 2) for i in range(23)]
    rows += [(3, 0, None, "n")]
    table = tokens(rows[::-1])
    wanted = [f"w{i}" for i in range(23) if i % 5]
    for size in (3, 7, 1000):
        lists = rows_of(k.word_lists(table, block_size=size), "doc_id")
        assert lists == [(1, wanted), (2, wanted)]
        text = rows_of(k.tokens_to_text(table, sep="|", block_size=size), "doc_id")
        assert text == [(1, "|".join(wanted)), (2, "|".join(wanted))]


def test_stopwords_follow_the_word_column(spark):
    table = spark.createDataFrame(
        [(1, 0, "a", "A", "n"), (1, 1, "b", "B", "n")],
        "doc_id long, token_id int, word string, form string, pos string",
    )
    assert rows_of(k.tokens_to_text(table, word_col="form", stopwords=["A", "b"])) == [(1, "B")]


def test_corpus_text_and_files(spark, tokens, tmp_path):
    table = tokens([(2, 0, "c", "n"), (1, 1, "b", "n"), (1, 0, "a", "n")])
    assert k.corpus_text(table) == "a b c"
    with pytest.raises(ValueError):
        k.corpus_text(table, max_chars=3)
    k.write_corpus_text(table, str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ["a b", "c"]


def test_reader_is_re_iterable(tokens):
    table = tokens([(2, 0, "c", "n"), (1, 1, "b", "n"), (1, 0, "a", "n"), (3, 0, None, "n")])
    reader = k.corpus_reader(table)
    assert list(reader) == [["a", "b"], ["c"]] == list(reader)
    assert list(k.corpus_reader(table, return_mode="id_tokens")) == [(1, ["a", "b"]), (2, ["c"])]
    assert list(k.corpus_reader(None)) == []
    with pytest.raises(ValueError):
        k.corpus_reader(table, return_mode="other")
    assert rows_of(k.read_range(table, 1, 2).select("doc_id").distinct(), "doc_id") == [(1,), (2,)]


# -- derived tables ----------------------------------------------------------------


def test_derived_rules_per_document(spark, tokens):
    docs = spark.createDataFrame([(i,) for i in range(1, 6)], "doc_id long")
    table = tokens([(1, 0, "a", "n"), (2, 0, "b", "n"), (2, 1, "b", "n"), (3, 0, "c", "n")])

    def damage(df):
        twice = df.where("doc_id = 2").withColumn("token_id", F.lit(0))
        holes = df.where("doc_id = 3").withColumn("word", F.lit(None).cast("string"))
        foreign = df.where("doc_id = 1").withColumn("doc_id", F.lit(77).cast("long"))
        ok = df.where("doc_id = 1").withColumn("extra", F.lit(1)).drop("pos")
        return ok.unionByName(twice, True).unionByName(holes, True).unionByName(foreign, True)

    accepted, verdict = k.derive_tokens(table, docs, damage)
    assert rows_of(accepted) == [(1, 0, "a", None, None)]
    assert rows_of(verdict, "doc_id") == [
        (1, True, None), (2, False, "duplicate"), (3, False, "null_word"), (4, True, None), (5, True, None),
    ]
    none, done = k.derive_tokens(table, docs, lambda df: None)
    assert none.count() == 0 and done.where("ok").count() == 5
    with pytest.raises(TypeError):
        k.derive_tokens(table, docs, "no")
    with pytest.raises(KeyError):
        k.derive_tokens(table, docs, lambda df: df.drop("word"))


def test_structured_info_becomes_json(tokens):
    table = tokens([(1, 0, "a", "n")]).withColumn("token_info", F.struct(F.lit("語").alias("s")))
    assert rows_of(k.fit_schema(table))[0][4] == '{"s":"語"}'


def test_pandas_transform_isolates_failures(spark):
    def transform(frame):
        if (frame["word"] == "bad").any():
            raise ValueError("bad word")
        if (frame["word"] == "none").all() and len(frame):
            return None
        return frame[frame["word"] != "x"]

    docs = docs_of(spark, "a x b", "bad", "none", "")
    lists = k.derive_lists(k.tokenize_lists(docs), transform)
    found = {r["doc_id"]: r for r in lists.collect()}
    assert [(t["token_id"], t["word"]) for t in found[1]["tokens"]] == [(0, "a"), (2, "b")]
    assert found[2]["tokens"] is None and "bad word" in found[2]["error"]
    assert found[3]["tokens"] == [] and found[4]["tokens"] == []


def test_document_tokens_are_stored_without_a_shuffle_of_tokens(spark, tmp_path, monkeypatch):
    """The token table of the documents, files sorted; what meets in the shuffle are texts."""
    from kotonoha.sources import sinks

    written = []
    write = sinks._write
    monkeypatch.setattr(sinks, "_write", lambda rows, *rest: (written.append(rows), write(rows, *rest)))
    texts = [(i * 7 % 60, f"text {i} - of 1.5 words " * (i % 5)) for i in range(60)]
    texts += [(3, "again"), (3, "and again"), (None, "no id"), (None, "none"), (61, None), (62, "")]
    docs = spark.createDataFrame(texts, "key long, body string").repartition(7)
    columns = dict(id_col="key", text_col="body")
    for name, options in (("script", {}), ("typed", {"variant_info": True}), ("called", {"tokenizer": _split})):
        path = str(tmp_path / name)
        sinks.write_document_tokens(docs, path, **columns, **options)
        plain = {k: v for k, v in options.items() if k != "variant_info"}
        expected = k.tokenize(docs, **columns, **plain).withColumnRenamed("key", "doc_id")
        stored = sinks.read_tokens(spark, path)
        assert sorted(map(str, rows_of(stored.drop("token_info")))) == sorted(map(str, rows_of(expected.drop("token_info"))))
        for file in (tmp_path / name).glob("*.parquet"):
            keys = [(r["doc_id"], r["token_id"]) for r in pq.read_table(file).to_pylist()]
            known = [x for x in keys if x[0] not in (None, 3)]
            assert known == sorted(known)
            assert [x[0] or -1 for x in keys] == sorted(x[0] or -1 for x in keys)
    for rows in written:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Sort [") == 1
        # The lower a step, the later it is named: tokens are made above the exchange of texts.
        assert plan.index("token_id") < plan.index("RepartitionByExpression")
        assert "token_id" not in plan[plan.index("RepartitionByExpression") :]


def test_token_sink_round_trip(spark, tmp_path):
    from kotonoha.sources.sinks import read_tokens, write_tokens

    table = k.tokenize(docs_of(spark, "a b", "c"))
    write_tokens(table, str(tmp_path / "t"))
    assert sorted(rows_of(read_tokens(spark, str(tmp_path / "t")))) == sorted(rows_of(table))


def test_no_hidden_renumbering(spark):
    table = k.tokenize(docs_of(spark, "a . b . c"))
    kept = k.filter_tokens(table, pos_keep="word")
    assert [r[1] for r in rows_of(kept, "token_id")] == [0, 2, 4]
    assert re.match("a", rows_of(kept, "token_id")[0][2])


def test_stopwords_of_lists_in_any_number(spark, tokens, monkeypatch):
    """Few literals, many literals and tables give the rows of the long form."""
    from kotonoha.operators import lists as list_module
    from kotonoha.operators.reader import collect_tokens

    table = tokens([(d, i, w, "x") for d in (1, 2, None) for i, w in enumerate(["a", "b", None, "c", "a"])])
    rows = collect_tokens(table.withColumn("token_info", F.lit(None).cast("string")))
    frequent = spark.createDataFrame([("c", 3)], "word string, count long")
    for stopwords in (["a"], ["a", "c"], frequent, ["a", frequent]):
        want = rows_of(k.tokens_to_text(table, stopwords=stopwords, strict=False).where("doc_id IS NOT NULL"), "doc_id")
        for limit in (100, 0):
            monkeypatch.setattr(list_module, "LITERAL_STOPWORDS", limit)
            kept = list_module.filter_lists(rows, stopwords=stopwords)
            assert kept.columns == rows.columns and kept.count() == 3
            assert rows_of(list_module.text_of_lists(kept).where("doc_id IS NOT NULL"), "doc_id") == want


ODD_INFOS = [
    '{"surface":"A","dictionary_form":"b","normalized_form":"c","pos_detail":["word"]}',
    '{"surface":"A","dictionary_form":"b","normalized_form":"","pos_detail":["word"]}',
    '{"surface":"A","dictionary_form":"b","normalized_form":"c","pos_detail":["word"]',
    '{"surface":"A","dictionary_form":"b","normalized_form":"c","pos_detail":["word"]}\n',
    '{"surface":"\\"","dictionary_form":"\\"","normalized_form":"\\"","pos_detail":["symbol"]}',
    '{"surface":"x","sub":{"normalized_form":"no"}}',
    '{"base_form":"b","surface":"s"}',
    "no JSON",
    None,
]


@pytest.mark.parametrize("form, key", [("surface", "surface"), ("norm", "normalized_form"), ("dict", "dictionary_form")])
def test_forms_read_without_parsing_are_those_of_the_json(spark, form, key):
    tokens = spark.createDataFrame([(i, "w", t) for i, t in enumerate(ODD_INFOS)], "n int, word string, token_info string")
    parsed = [F.get_json_object("token_info", f"$.{x}") for x in (key, *(["base_form"] if form == "dict" else []))]
    want = rows_of(tokens.select("n", F.coalesce(*parsed, "word")), "n")
    assert rows_of(k.select_word_form(tokens, form).select("n", "word"), "n") == want


def test_plain_info_is_not_parsed(spark):
    """Every token but an escaped one is read by the pattern, which must follow ``script_info``."""
    info = k.tokenize(docs_of(spark, "Das Été 漢字 かな 12.5 , é"))
    plain = F.regexp_extract_all("token_info", F.lit(plain_pattern("normalized_form")), F.lit(1))
    found = rows_of(info.select("token_id", F.get(plain, F.lit(0))), "token_id")
    assert [r[1] for r in found] == ["das", "été", "漢字", "かな", "12.5", ",", "é"]


def test_script_pattern_is_that_of_the_classes(spark):
    """Every code point between tokens of all kinds, against the classes without ranges."""
    plain = (
        r"[\p{L}\p{M}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]]+|\p{IsHan}+|\p{IsHiragana}+|[\p{IsKatakana}ー]+"
        r"|\p{Nd}+(?:\.\p{Nd}+)?|[^\p{L}\p{M}\p{Nd}\p{IsWhite_Space}\x1c-\x1f]"
    )
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}漢{c}ひ{c}カ{c}1{c}{c}.{c}2" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    docs = docs_of(spark, *texts)
    assert docs.where(F.regexp_extract_all("text", F.lit(plain), F.lit(0)) != script_words(F.col("text"))).count() == 0
    first = F.substring("word", 1, 1)
    pos = F.when(first.rlike(r"[\p{L}\p{M}]"), "word").when(first.rlike(r"\p{Nd}"), "number").otherwise("symbol")
    assert k.tokenize(docs).where(F.col("pos") != pos).count() == 0
