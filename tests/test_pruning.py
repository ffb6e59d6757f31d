"""Keys that cannot reach a minimum count stay out of the shuffle."""

import pytest
from pyspark.sql import functions as F

from kotonoha.operators.frequency import vocabulary
from kotonoha.operators.ngram import count_ngrams, count_ngrams_of_lists
from kotonoha.operators.pruning import open_buckets, prune_rare
from tests.conftest import rows_of


def shuffled_rows(found):
    """Rows written by the exchanges of a plan that has run."""
    total, todo = 0, [found._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.fixture
def plain_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def lists(spark):
    """Mostly n-grams that stand once, some that stand often, over several partitions."""
    rows = [(d, [f"w{d}_{i}" for i in range(40)] + ["a", "b", "c"] + [f"v{(d + i) % 7}" for i in range(5)]) for d in range(60)]
    return spark.createDataFrame(rows, "doc_id long, words array<string>").repartition(4)


@pytest.mark.parametrize("buckets", [1, 64, 1000, 1 << 20])
@pytest.mark.parametrize("min_count", [2, 5, 300])
def test_rows_are_unchanged(spark, buckets, min_count):
    texts = lists(spark)
    plain = count_ngrams_of_lists(texts, n=2, min_count=min_count)
    pruned = count_ngrams_of_lists(texts, n=2, min_count=min_count, buckets=buckets)
    assert rows_of(pruned, "ngram") == rows_of(plain, "ngram")


def test_fewer_rows_are_shuffled(spark, plain_plans):
    texts = lists(spark)

    def run(**options):
        found = count_ngrams_of_lists(texts, n=3, min_count=2, ordered=False, **options)
        found.collect()
        return shuffled_rows(found)

    assert run(buckets=1 << 18) < 0.5 * run()


def test_open_buckets_add_up_over_tasks(spark):
    """A key that stands once in each of many tasks is found."""
    rows = spark.range(8, numPartitions=8).select(F.lit("x").alias("k"), "id")
    assert prune_rare(rows, "k", 8, 100).count() == 8
    assert prune_rare(rows, "k", 9, 100).count() == 0
    assert open_buckets(rows, "k", 9, 100).count() == 0


def test_tokens_and_words(spark, tokens):
    table = tokens([(d, i, w, "x") for d in range(3) for i, w in enumerate(["a", "b", None, f"c{d}"])])
    for options in ({}, {"buckets": 512}):
        assert rows_of(vocabulary(table, min_count=3, **options), "word") == [("a", 3), ("b", 3)]
        assert rows_of(count_ngrams(table, n=2, min_count=2, **options)) == [("a b", 3)]
    assert prune_rare(table.where("false"), "word", 2, 8).count() == 0
    with pytest.raises(ValueError):
        prune_rare(table, "word", 2, 0)
