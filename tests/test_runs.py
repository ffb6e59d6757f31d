"""Token rows merged before the shuffle."""

import random

from pyspark.sql import functions as F

import kotonoha as k
from kotonoha.operators.reader import collect_tokens, tokens_to_text
from kotonoha.operators.runs import token_runs

SCHEMA = "doc_id long, token_id int, word string, pos string, token_info string"


def shuffles(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")


def test_neighbouring_tokens_are_one_row(spark):
    rows = [(d, i, f"w{i % 7}", "word", None) for d in range(5) for i in range(200)]
    tokens = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    runs = token_runs(tokens, id_col="doc_id", order_col="token_id", item_cols=["word"], block_size=150)
    found = runs.select("doc_id", "_block", F.size("_run.number"), F.size("_run.items")).collect()
    assert sorted(map(tuple, found)) == [(d, b, n, 7) for d in range(5) for b, n in ((0, 150), (1, 50))]


def test_words_are_moved_once(spark):
    rows = [(d, i, "w", "word", None) for d in range(3) for i in range(9)]
    tokens = spark.createDataFrame(rows, SCHEMA)
    for made in (tokens_to_text(tokens), k.word_lists(tokens), collect_tokens(tokens)):
        made.collect()
        assert shuffles(made) == 1
        assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2


def test_rows_in_any_order_with_nulls_and_copies(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice([None, -1, 1, 2, 3]), rng.choice([None, *range(40)]), rng.choice([None, "", "a", "b", "ü"]),
         rng.choice([None, "word"]), rng.choice([None, "{}"]))
        for _ in range(900)
    ]
    tokens = spark.createDataFrame(rows, SCHEMA).repartition(3)

    def key(row):
        return [(x is not None, x if x is not None else 0) for x in row]

    wanted = {d: sorted((r[1:] for r in rows if r[0] == d), key=key) for d in {r[0] for r in rows}}
    found = {r["doc_id"]: [tuple(t) for t in r["tokens"]] for r in collect_tokens(tokens, block_size=16).collect()}
    blocks = {d: sorted(ts, key=lambda t: ((t[0] is not None, (t[0] or 0) // 16), key(t))) for d, ts in wanted.items()}
    assert found == blocks
    words = {r["doc_id"]: r["words"] for r in k.word_lists(tokens.where("token_id IS NOT NULL"), block_size=16).collect()}
    assert words == {d: [t[1] for t in ts if t[0] is not None and t[1] is not None] for d, ts in wanted.items()}


def test_items_with_any_characters_come_back(spark):
    odd = ["", "\x01", "\x02", "\x03", "\x03a", "\x03c\x01", "a\x01b", "\x02\x02", None, "plain", "\x00"]
    rows = [(1, i, w, odd[-1 - i], odd[(i * 3) % len(odd)]) for i, w in enumerate(odd)]
    found = collect_tokens(spark.createDataFrame(rows, SCHEMA).coalesce(1)).first()["tokens"]
    assert [tuple(t) for t in found] == [r[1:] for r in rows]


def test_long_runs_are_cut(spark):
    """Item numbers take two bytes; a run with more rows becomes several."""
    tokens = spark.range(70_000).coalesce(1).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit(0).alias("token_id"), F.col("id").cast("string").alias("word"),
        F.lit("word").alias("pos"), F.lit(None).cast("string").alias("token_info"),
    )
    words = collect_tokens(tokens).first()["tokens"]
    assert sorted(int(t["word"]) for t in words) == list(range(70_000))
