import re

from kotonoha.llm import quality
from tests.llm.helpers import empty_documents, odd_documents, prose


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "n_lines": len(lines),
        "n_capitals": len(re.findall("[A-Z]", text)),
        "n_exclaims": text.count("!"),
    }


def test_counts_equal_brute_force(spark):
    texts = [
        None, "", "  ", "a b c d", "a b c d e", "a b c d e a b c d e", "x x x x x x x x", "One\nOne\n\n One\nTwo!",
        "a b c d e f a b c d e g b c d e f", "#1 *2* $3 &amp; <b>|", "tab\tand\x0bvt\x0cff\rcr nbsp", "É\U0001f600 ß",
        prose(1, 40, list("abc")), prose(2, 200, list("abcd")),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality.text_counts(docs).collect():
        assert {c: row[c] for c in quality.COUNTS} == counted(texts[row["doc_id"]]), texts[row["doc_id"]]


def plain_em(votes, rules):
    import math

    good = [max(0.95 - 0.4 * sum(v < 0 for v in row), 0.05) for row in votes]
    for _ in range(quality.ITERATIONS):
        n, g = len(votes), sum(good)
        odds = [math.log((g + 1) / (n - g + 1))] * n
        for k in range(rules):
            for i, row in enumerate(votes):
                same = [j for j in range(n) if votes[j][k] == row[k]]
                inside = sum(good[j] for j in same)
                odds[i] += math.log((inside + 1) / (g + 3)) - math.log((len(same) - inside + 1) / (n - g + 3))
        good = [1 / (1 + math.exp(-o)) for o in odds]
    return good


def test_em_equals_plain_em(spark):
    votes = [(1, 1, 1), (1, 1, 0), (-1, -1, 1), (-1, -1, 0), (1, 0, 1), (0, 1, 1), (-1, -1, -1), (1, 1, 1)]
    table = spark.createDataFrame([(i, *v) for i, v in enumerate(votes)], "i int, _v0 int, _v1 int, _v2 int")
    model = quality.fit_votes(table, 3)
    from pyspark.sql import functions as F

    found = table.select("i", (1 / (1 + F.exp(-model.log_odds()))).alias("q")).orderBy("i").collect()
    wanted = plain_em(votes, 3)
    assert all(abs(r["q"] - w) < 1e-9 for r, w in zip(found, wanted, strict=True))


def test_keeps_prose_and_drops_junk(spark):
    good = [(i, prose(i, 120)) for i in range(60)]
    junk = [(100 + i, " ".join(w.upper() + "***" for w in prose(i, 120).split())) for i in range(8)]
    found = quality.judge_quality(spark.createDataFrame(good + junk, "doc_id long, text string"))
    assert {r["doc_id"] for r in found.where("kept").collect()} == set(range(60))


def test_no_python_on_the_main_path(spark):
    docs = odd_documents(spark)
    plan = quality.text_counts(docs)._jdf.queryExecution().executedPlan().toString()
    judged = quality.judge_quality(docs)
    plan += judged._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    found = quality.judge_quality(docs)
    rows = found.collect()
    assert len(rows) == docs.count()
    assert all(not r["kept"] and r["base_failed"] for r in rows if r["doc_id"] in (2, 3, 4))
    assert all(r["kept"] in (True, False) for r in rows)
    assert quality.judge_quality(empty_documents(spark)).count() == 0
