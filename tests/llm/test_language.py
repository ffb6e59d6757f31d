import numpy as np
import pytest

from kotonoha.llm import langid
from tests.llm.helpers import empty_documents, odd_documents

WORDS = {
    "en": "the of and to in is that for with was this are from have not which you had they were".split(),
    "de": "der die und das ist nicht mit dem ein eine auf für sich auch werden über nach durch".split(),
    "fr": "le la les des une que pour dans qui est pas avec sur sont mais nous comme leur été".split(),
}


def labelled(spark, n=60):
    rng = np.random.default_rng(3)
    rows = []
    for lang, words in WORDS.items():
        rows += [(int(i), " ".join(rng.choice(words, 25)), lang) for i in range(n)]
    return spark.createDataFrame([(k, t, y) for k, (_, t, y) in enumerate(rows)], "doc_id long, text string, lang string")


def test_kernel_equals_brute_force():
    texts = ["abc abd", "abc", "xyz?", "Ünder"]
    sets = []
    for t in texts:
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        sets.append({s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)})
    found = [set(langid.spectrum(t).tolist()) for t in texts]
    for a in range(4):
        for b in range(4):
            assert len(found[a] & found[b]) == len(sets[a] & sets[b])


def test_spectrum_of_a_long_text_has_no_seam(monkeypatch):
    text = "abcdefghij klmnop " * 50
    whole = langid.spectrum(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert (langid.spectrum(text) == whole).all()


def test_learns_languages(spark):
    docs = labelled(spark)
    model = langid.train(docs.where("doc_id % 4 != 2"))
    assert model.languages == ("de", "en", "fr")
    found = langid.identify(docs.where("doc_id % 4 = 2"), model).join(docs, "doc_id")
    assert found.where("lang_pred != lang").count() == 0
    assert found.where("score < 0.5 OR score > 1").count() == 0


def test_draw_is_bounded_and_repeatable(spark):
    docs = labelled(spark, 100)
    docs = docs.unionByName(docs).unionByName(docs)
    first = langid.labelled_spectra(docs, per_language=20)
    again = langid.labelled_spectra(docs.repartition(7), per_language=20)
    assert [(y, g.tolist()) for y, g in first] == [(y, g.tolist()) for y, g in again]
    counts = {y: sum(1 for z, _ in first if z == y) for y in WORDS}
    assert all(5 <= n <= 20 for n in counts.values())


def test_odd_rows(spark):
    model = langid.train(labelled(spark))
    docs = odd_documents(spark)
    found = langid.identify(docs, model)
    assert found.columns == ["doc_id", "lang_pred", "score", "margin"]
    assert found.count() == docs.count()
    rows = {r["doc_id"]: r for r in found.collect()}
    for key in (2, 3, 4, 6):
        assert (rows[key]["lang_pred"], rows[key]["score"]) == ("und", 0.0)
    assert rows[1]["lang_pred"] == "en"
    kept = langid.filter_languages(docs, model, min_score=0.0)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} == {1, None, 5, 7, 8}
    assert langid.filter_languages(docs, None, min_score=0.3).count() == 6


def test_empty_tables(spark):
    none = empty_documents(spark)
    assert langid.train(none) is None
    assert langid.identify(none, None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd_documents(spark), None).collect()} == {"und"}


@pytest.mark.parametrize("labels", [["en"], ["de", "en", "en"]])
def test_few_labels(labels):
    spectra = [langid.spectrum(" ".join(WORDS[y])) for y in labels]
    model = langid.fit(spectra, labels)
    assert np.isfinite(model.weights).all()
