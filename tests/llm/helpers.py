"""Small tables with the odd cases that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Letters of two and four bytes, and a separator that is no line end.
ODD_TEXT = "Straße Été \U0001f600 naïve\u2028word"
# Names that operators use inside or return.
CLASHES = {"score": 1, "_id": 2, "_text": 3, "label": 4, "keep": 5, "length": 6, "_drops": 7, "shard": 8, "_key": 9, "_hash": 10, "_doc": 11, "_fp": 12, "_bits": 13}


def odd_documents(spark, extra=(), clashes=True):
    rows = [
        (1, "The quick brown fox jumps over the lazy dog.\nA second line.", "en", "a", 58),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n\x0b ", None, "a", 5),
        (None, "a text without an id, and a few more words in it", "en", "a", 48),
        (5, "same text in two rows", "en", "a", 21),
        (5, "same text in two rows", "en", "a", 21),
        (6, "123 456 --- 7", "en", None, 13),
        (7, "long " * 30_000 + "end.", "en", "a", 150_004),
        (8, ODD_TEXT, "de", "a", 20),
        *extra,
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        for name, value in CLASHES.items():
            docs = docs.selectExpr("*", f"{value} AS `{name}`")
    return docs


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, n, words=None):
    draw = random.Random(seed)
    words = words or [f"w{i}" for i in range(500)]
    return " ".join(draw.choice(words) for _ in range(n))
