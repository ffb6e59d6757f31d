import hashlib
import random
import string

from kotonoha.llm import lines
from tests.llm.helpers import empty_documents, odd_documents

SPACES = " \t\n\x0b\x0c\r"


def plain(rows, min_docs, min_chars=1):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

    def key(line):
        return line.strip(SPACES).translate(lower)

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc if doc is not None else ("text", text))
    bad = {k for k, d in holders.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for doc, text in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if key(p) not in bad]
        text = "\n".join(kept)
        out.append((doc, len(parts), len(parts) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(docs, **options):
    rows = lines.drop_repeated_lines(docs, **options).collect()
    return sorted(
        (
            (r["doc_id"], r["_n_lines"], r["_n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest())
            for r in rows
        ),
        key=repr,
    )


def random_rows(seed, n):
    draw = random.Random(seed)
    common = [f"Line {i}" for i in range(12)] + ["", "  ", "\tLINE 3 ", "é\x0b"]
    return [
        (i, "\n".join(draw.choice(common[: draw.randint(1, 16)]) if draw.random() < 0.7 else f"own {i} {k}" for k in range(draw.randint(0, 9))))
        for i in range(n)
    ]


def test_equals_brute_force(spark):
    for seed, min_docs in ((1, 3), (2, 10), (3, 1)):
        rows = random_rows(seed, 80)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        assert found(docs, min_docs=min_docs) == plain(rows, min_docs)


def test_a_hot_line_over_many_tasks(spark):
    rows = [(i, f"hot line\nown {i}\nHOT LINE" if i % 3 else f"own {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = lines.line_rows(docs, 1, "doc_id", "text").repartitionByRange("_hash", "_doc")
        from pyspark.sql import functions as F

        made = made.withColumn("task", F.spark_partition_id())
        hot = made.groupBy("_hash").agg(F.countDistinct("task").alias("n")).agg(F.max("n")).first()[0]
        assert hot > 3  # the hot hash is dealt over several tasks
        assert found(docs) == plain(rows, 10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hashes_at_the_ends_of_tasks(spark):
    # Every task holds a part of the documents of one hash: no task alone sees ten.
    rows = [(i, "one line") for i in range(12)] + [(100 + i, "few") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == plain(rows, 10)


def test_min_chars_and_many_rows_of_one_document(spark, monkeypatch):
    monkeypatch.setattr(lines, "HELD_ROWS", 3)
    rows = [(i % 4, f"Repeated\nab\n{i}") for i in range(40)] + [(None, f"ab\n{i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs, min_docs=4, min_chars=3) == plain(rows, 4, 3)
    assert found(docs, min_docs=7) == plain(rows, 7)


def test_bitmaps_hold_no_text(spark):
    docs = spark.createDataFrame([(i, f"same\nown {i}") for i in range(10)], "doc_id long, text string")
    maps = lines.keep_bitmaps(docs)
    assert maps.columns == ["doc_id", "text_hash", "n_lines", "n_dropped", "keep"]
    assert {(r["n_lines"], r["n_dropped"]) for r in maps.collect()} == {(2, 1)}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = lines.drop_repeated_lines(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["text"] is None and by_id[2]["_n_lines"] == 1 and by_id[3]["_n_lines"] == 1
    assert by_id[4]["_n_lines"] == 2 and by_id[4]["_n_dropped"] == 0
    assert by_id[1]["_id"] == 2 and by_id[1]["keep"] == 5
    assert lines.drop_repeated_lines(empty_documents(spark)).count() == 0
