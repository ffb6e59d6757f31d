"""Topics trained in blocks of words."""

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from kotonoha.operators import models as m
from kotonoha.operators import topics

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("counts", VectorUDT())])


@pytest.fixture
def corpus(spark):
    rng = np.random.default_rng(1)
    rows = []
    for d in range(400):
        words, counts = np.unique(rng.integers(0, 20, 60) + 20 * (d % 2), return_counts=True)
        rows.append((d, Vectors.sparse(41, words.tolist(), counts.astype(float).tolist())))
    return spark.createDataFrame([*rows, (400, Vectors.sparse(41, [], [])), (401, Vectors.dense([1.0] + [0.0] * 40))], SCHEMA)


def shares(model, frame):
    found = model.transform(frame).select("doc_id", vector_to_array("topicDistribution").alias("t")).collect()
    return {r["doc_id"]: np.array(r["t"]) for r in found}


def test_documents_of_one_subject_share_a_topic(corpus, monkeypatch):
    monkeypatch.setattr(topics, "CELLS_AT_ONCE", 100)
    found = shares(m.train_topics(corpus, topics=2, epochs=60, seed=3), corpus)
    assert len(found) == 402 and found[400].tolist() == [0.0, 0.0]
    assert all(abs(t.sum() - 1) < 1e-9 for d, t in found.items() if d != 400)
    kinds = {half: {int(found[d].argmax()) for d in range(half, 400, 2)} for half in (0, 1)}
    assert sorted(map(len, kinds.values())) == [1, 1] and kinds[0] != kinds[1]


def test_one_update_is_the_one_of_mllib(spark, corpus, monkeypatch):
    """From the same weights a document's topics are MLlib's; all documents seen, none drawn twice."""
    model = LDA(k=3, maxIter=2, seed=1, optimizer="online", featuresCol="counts", learningOffset=1.0).fit(corpus)
    weights = model.topicsMatrix().toArray()
    blocks = spark.createDataFrame([(0, weights.ravel().tolist(), np.exp(topics._digamma(weights)).ravel().tolist())], topics._MODEL)
    ours = topics.TopicModel(topics._kept(blocks, 41, 3), np.array(model.estimatedDocConcentration().toArray()), 1, "counts")
    theirs = {r["doc_id"]: np.array(r["topicDistribution"].toArray()) for r in model.transform(corpus).collect()}
    for d, t in shares(ours, corpus).items():
        assert t == pytest.approx(theirs[d], abs=5e-3)


def test_words_of_several_blocks_never_meet_the_driver(spark, corpus, monkeypatch):
    whole = shares(m.train_topics(corpus, topics=2, epochs=2, seed=3), corpus)
    assert np.allclose(topics._digamma(np.array([1.0, 0.5, 10.0])), [-0.5772156649, -1.9635100260, 2.2517525891])
    assert np.allclose(topics._trigamma(np.array([1.0, 0.5, 10.0])), [1.6449340668, 4.9348022005, 0.1051663357])
    assert len(whole) == 402
    none = spark.createDataFrame([(1, Vectors.sparse(0, [], []))], SCHEMA)
    assert shares(m.train_topics(none, topics=2, epochs=2), none)[1].tolist() == [0.0, 0.0]
    with pytest.raises(ValueError):
        m.train_topics(none.limit(0), topics=2)
