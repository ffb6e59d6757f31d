import random

from kotonoha.llm import toxicity
from kotonoha.llm.common import fold
from tests.llm.helpers import empty_documents, odd_documents, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    draw = random.Random(4)
    terms = ["scum", "idiot", "moron", "worthless", "disgusting", "idiom"]
    automaton = toxicity.TermAutomaton({t: 1.0 for t in terms}, {})
    words = list(terms)
    for _ in range(3000):
        word = list(draw.choice(terms))
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(word))
            word[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "i", "ß", "s"])
        words.append("".join(word))
    for word in words:
        within = [distance(word, t) for t in terms if distance(word, t) <= toxicity.allowed_edits(t)]
        found = automaton.match(word)
        assert (found is not None) is bool(within), word
        if found:
            assert distance(word, found[0]) == min(within)
            assert found[2] is (min(within) > 0)


def test_forgetting_changes_nothing(monkeypatch):
    terms = {t: 1.0 for t in ("idiot", "moron", "worthless")}
    words = [f"{a}{b}" for a in ("idiot", "mor0n", "worthles", "fine", "idiom") for b in ("", "s", "x", "ed")] * 2
    plain = toxicity.TermAutomaton(terms, {})
    want = [plain.match(w) for w in words]
    assert plain.match("x" * 500) is None and plain.match("x" * 500) is None
    monkeypatch.setattr(toxicity, "VERDICTS", 3)
    monkeypatch.setattr(toxicity, "PLACES", 9)
    bounded = toxicity.TermAutomaton(terms, {})
    assert [bounded.match(w) for w in words] == want
    assert len(bounded.verdicts) <= 3


def test_a_long_word_is_learned_whole(spark):
    rows = [(i, ("q" * 100 if i % 2 else "fine") + f" and so on {i}", i % 2) for i in range(40)]
    both = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(both.select("doc_id", "text"), both.select("doc_id", "toxic"))
    assert "q" * 100 in model.words


def test_stems():
    automaton = toxicity.TermAutomaton({"clown": 1.0}, {"lowei": 0.5, "ab": 0.2})
    assert automaton.match("loweixyz")[:2] == ("lowei", 0.5)
    assert automaton.match("lowe") is None
    assert automaton.match("abandon")[:2] == ("ab", 0.2)
    assert automaton.match("cl0wn") == ("clown", 0.7, True)


def test_misspellings_inside_a_stem():
    texts = {"idiot": 100, "idiots": 60, "idiotic": 20}
    rows = [("=" + w, n, 0) for w, n in texts.items()]
    rows += [("^idiot"[: n + 1], 180 if n < 5 else 80, 0) for n in (3, 4, 5)]
    words, stems = toxicity.choose_terms(rows, 400, 400)
    assert stems and set(texts) <= set(words)
    automaton = toxicity.TermAutomaton(words, stems)
    for word in ("id1ot", "iddiot", "iidiots", "idi0tic"):
        assert automaton.match(word)[2] is True, word
    for word in ("idiot", "idiots", "idiotically"):
        term, weight, misspelled = automaton.match(word)
        assert term in stems and weight == stems[term] and not misspelled
    assert toxicity.hits("one idiots", automaton, frozenset())[1] == {("idiots", False): stems[term]}
    assert automaton.match("ideal") is None


def test_all_telling_terms_and_each_text_once(spark):
    words, stems = toxicity.choose_terms([(f"=term{i}", 6, 0) for i in range(1000)], 2000, 2000)
    assert len(words) == 1000 and not stems
    both = corpus(spark, 100)
    docs, labels = both.select("doc_id", "text"), both.select("doc_id", "toxic")
    once, thrice = toxicity.train(docs, labels), toxicity.train(docs.union(docs).union(docs), labels)
    assert once.words and (once.words, once.stems, once.harmless) == (thrice.words, thrice.stems, thrice.harmless)


def test_context():
    automaton = toxicity.TermAutomaton({"idiot": 1.0}, {})
    weight = lambda text: sum(toxicity.hits(text, automaton, frozenset())[1].values())
    plain = weight("one two idiot three four five")
    assert weight('they wrote "what an idiot" in the letter') < plain
    assert weight("the word idiot comes from far away") < plain
    assert weight("you are an idiot my friend") > plain
    assert weight("one two 1diot three four") < plain
    assert weight("nothing here") == 0


def corpus(spark, n=400):
    rows = []
    for i in range(n):
        words = prose(i, 60).split()
        toxic = i % 5 == 0
        if toxic:
            for k in range(3):
                words.insert(10 * k + 5, ["idiot", "moron", "worthless"][(i + k) % 3])
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_learns_a_lexicon(spark):
    both = corpus(spark)
    docs, labels = both.select("doc_id", "text"), both.select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(fold("doc_id", 5) != 0))
    assert {"idiot", "moron", "worthless"} <= set(model.words)
    held = both.where(fold("doc_id", 5) == 0)
    found = toxicity.score_toxicity(held, model).join(labels, "doc_id")
    assert found.where("predicted != toxic").count() == 0
    assert found.where("score < 0 OR score > 1 OR predicted != int(score >= 0.5)").count() == 0


def test_odd_rows(spark):
    both = corpus(spark, 100)
    model = toxicity.train(both.select("doc_id", "text"), both.select("doc_id", "toxic"))
    docs = odd_documents(spark, [(9, "you idiot, you MORON, worthless worthlesss", "en", "a", 1)])
    rows = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert rows[9]["predicted"] == 1
    assert rows[2]["score"] == rows[3]["score"] == rows[4]["score"] < 0.5
    assert toxicity.score_toxicity(empty_documents(spark), model).count() == 0


def test_without_labels(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model == toxicity.ToxicityModel()
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()} == {0}
    assert toxicity.train(empty_documents(spark), labels.where("false")) == toxicity.ToxicityModel()
