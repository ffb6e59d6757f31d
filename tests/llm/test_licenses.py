import random
import re
import time

from kotonoha.llm import licenses
from tests.llm.helpers import empty_documents, odd_documents


def test_templates_accept_their_wording():
    one = licenses.compile_template("x", "a <<opt>>b c<</opt>> <<any:2>> d")
    for text, accepted in (
        ("a d", True), ("a b c d", True), ("a b d", True), ("a q q d", True), ("a b c q q d", True),
        ("a q q q d", False), ("a c b c", False), ("z d", False),
    ):
        assert licenses.accepts(one, text.encode().split(), 0) is accepted, text
    nested = licenses.compile_template("y", "a <<opt>>b <<opt>>c<</opt>> d<</opt>> e")
    assert [licenses.accepts(nested, t.encode().split(), 0) for t in ("a e", "a b d e", "a b c d e", "a c d e")] == [
        True, True, True, False,
    ]


def test_automata_equal_patterns():
    texts = ["licensed under the apache license 2 0", "the mit license", "licensed under q w cc by nc", "is the mit licence"]
    texts += [re.sub(r"<<[^>]*>>", "", t) for _, t in licenses.TEMPLATES]
    texts += [re.sub(r"<<opt>>.*?<</opt>>", "", t) for _, t in licenses.TEMPLATES]
    for label, template in licenses.TEMPLATES:
        automaton = licenses.compile_template(label, template)
        pattern = re.compile(licenses.template_regex(template))
        for text in texts:
            words = text.encode().split()
            found = any(licenses.accepts(automaton, words, i) for i in range(len(words)))
            assert found is bool(pattern.search(" " + " ".join(text.split()) + " ")), (template, text)


def test_places_and_labels():
    scan = licenses.LicenseScanner().scan
    text = "See: Apache License.\nMIT-License, MIT license; GNU General\nPublic License"
    assert scan(text) == (11, 4, 1, 7, "apache,gpl,mit", "apache,gpl,mit", 0.5)
    assert scan("Licensed under the Apache License, Version 2.0.")[4:] == ("apache", "apache,apache-2.0", 1.0)
    assert scan("Licensed under CC BY-NC 4.0.")[4:] == ("cc-by", "cc-by,cc-by-nc-4.0", 1.0)
    assert scan("Licensed under the Apache licence, Version 2.0.")[4:] == ("", "", 0.0)
    assert scan("a plain text")[1:] == (0, None, None, "", "", 0.0)


def test_whole_wordings():
    scan = licenses.LicenseScanner().scan
    mit = re.sub("<<any:12>>", "the authors or copyright holders", re.sub("<</?opt>>", "", licenses._MIT))
    assert scan(f"Copyright X. {mit}")[5:] == ("mit", 1.0)
    assert scan(mit.replace("without restriction", "with restriction"))[5:] == ("", 0.0)
    opening = mit[: mit.index("including without")]
    assert scan(opening + "except that no commercial use is allowed") [5:] == ("", 0.0)
    assert scan("Unlike the MIT License, ours is strict")[4:] == ("mit", "mit", 0.5)
    assert scan("It is released under the terms of the MIT License.")[4:] == ("mit", "mit", 1.0)
    bsd = re.sub("<<any:12>>", "ACME and others", licenses._BSD_CONDITIONS + licenses._BSD_DISCLAIMER)
    for mark in ("1.", "*", ""):
        assert scan(re.sub("<<any:1>>", mark, bsd))[5:] == ("bsd-2-clause", 1.0)
    names = re.sub("<<any:12>>", "ACME", licenses._BSD_CONDITIONS + licenses._BSD_NAMES + licenses._BSD_DISCLAIMER)
    assert scan(re.sub("<<any:1>>", "", names))[5:] == ("bsd-3-clause", 1.0)


def test_one_pass_equals_single_automata():
    draw = random.Random(4)
    templates = [("a", "x y <<opt>>z<</opt>> x"), ("b", "y <<any:2>> z"), ("c", "x x y"), ("d", "<<opt>>y<</opt>> z z")]
    scanner = licenses.LicenseScanner({"x y": "p"}, templates)
    automata = [licenses.compile_template(*t) for t in templates]
    for _ in range(400):
        words = [draw.choice([b"x", b"y", b"z", b"q"]) for _ in range(draw.randint(0, 14))]
        want = {a.label for a in automata if any(licenses.accepts(a, words, i) for i in range(len(words)))}
        places = [i for i, w in enumerate(words) if w in scanner.first_words]
        assert scanner._labels(words, places) == want, words
        labels = scanner.scan(b" ".join(words).decode())[5]
        assert set(labels.split(",")) - {"", "p"} == want


def test_long_texts_in_linear_time():
    scan = licenses.LicenseScanner().scan
    for text in ("the is this licensed under software " * 27_000, "licensed under a b c d cc by " * 20_000):
        begin = time.process_time()
        scan(text)
        assert time.process_time() - begin < 1.5


def test_every_template_has_a_key_word():
    keys = licenses.LicenseScanner().keys
    for _, template in licenses.TEMPLATES:
        mandatory = re.sub(r"<<opt>>.*?<</opt>>|<<[^>]*>>", " ", template)
        assert keys & set(mandatory.encode().split()), template
    for phrase in licenses.PHRASES:
        assert keys & set(phrase.encode().split())


def test_odd_rows(spark):
    docs = odd_documents(spark, [(9, "x " * 5000 + "mit license", "en", "a", 1)])
    found = licenses.scan_licenses(docs)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == docs.count()
    assert (rows[2]["n_words"], rows[2]["labels"], rows[2]["first_word"]) == (0, "", None)
    assert (rows[9]["first_word"], rows[9]["base_labels"]) == (5000, "mit")
    assert licenses.scan_licenses(empty_documents(spark)).count() == 0
