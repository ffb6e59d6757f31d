"""License scans by template-markup matching.

A template is wording with marked regions: ``<<opt>> ... <</opt>>`` may be left
out, ``<<any:n>>`` stands for up to n words of any kind. A template compiles
into a token automaton (states are places in the template, moves read one word),
and a text carries the license if the automaton accepts some stretch of it, that
is, if all mandatory words stand there exactly and in order. Licenses are here
in full, so an opening clause that goes on otherwise is no license. Words are
runs of ASCII letters, digits and non-ASCII characters with A-Z in lower case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from kotonoha.llm.common import WORD_BYTES, scored_texts, utf8

def words_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(WORD_BYTES).split()


# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_MARK = re.compile(r"<<opt>>|<</opt>>|<<any:\d+>>|[^\s<]+")


def wording(text: str) -> str:
    """A template's text as its plain words and marks."""
    parts = re.split(r"(<<[^>]*>>)", text)
    return " ".join(p if p.startswith("<<") else " ".join(w.decode() for w in words_of(p)) for p in parts).strip()


# Public licenses in full, with the parts that users replace or leave out.
_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<opt>>(including the next paragraph)<</opt>> shall be included in
all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any:12>> BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_BSD_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<any:1>>
Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. <<any:1>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
<<any:1>> Neither the name of <<any:12>> nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY <<any:12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<any:12>>
BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_ISC = """
Permission to use, copy, modify, and<<opt>>/or<</opt>> distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<any:8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<any:8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
_APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at <<any:10>>
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
"""
_GPL_NOTICE = """
free software<<opt>>;<</opt>> you can redistribute it and/or modify it under the terms of the GNU <<opt>>Lesser<</opt>>
<<opt>>Affero<</opt>> General Public License as published by the Free Software Foundation<<opt>>, either version<</opt>>
<<any:12>> This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU <<opt>>Lesser<</opt>>
<<opt>>Affero<</opt>> General Public License for more details.
"""

# Label and wording; licenses and notices in full, then sentences that grant one by its name.
TEMPLATES = [
    (label, wording(text))
    for label, text in (
        ("mit", _MIT),
        ("bsd-2-clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
        ("bsd-3-clause", _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
        ("isc", _ISC),
        ("apache-2.0", _APACHE_NOTICE),
        ("gpl-notice", _GPL_NOTICE),
        ("apache-2.0", "licensed under the <<opt>>terms of the<</opt>> Apache License, <<opt>>Version<</opt>> 2.0"),
        ("mit", "licensed under the <<opt>>terms of the<</opt>> MIT License"),
        ("mit", "released under the <<opt>>terms of the<</opt>> MIT License"),
        (
            "gpl-3.0",
            "licensed under the <<opt>>terms of the<</opt>> GNU General Public License <<opt>>as published by the Free "
            "Software Foundation,<</opt>> <<opt>>either<</opt>> version 3",
        ),
        (
            "gpl-2.0",
            "licensed under the <<opt>>terms of the<</opt>> GNU General Public License <<opt>>as published by the Free "
            "Software Foundation,<</opt>> <<opt>>either<</opt>> version 2",
        ),
        ("cc-by-nc-4.0", "licensed under <<any:6>> CC BY-NC <<opt>>4.0<</opt>>"),
        ("cc-by-sa", "licensed under <<any:6>> CC BY-SA"),
        ("cc-by-4.0", "licensed under <<any:6>> CC BY 4.0"),
        ("cc-by-nc-4.0", "licensed under <<any:6>> Creative Commons Attribution-NonCommercial 4.0 <<opt>>International<</opt>>"),
        ("cc-by-4.0", "licensed under <<any:6>> Creative Commons Attribution 4.0 <<opt>>International<</opt>>"),
        ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
        ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
        ("mit", "SPDX-License-Identifier: MIT"),
        ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0 <<opt>>only<</opt>> <<opt>>or-later<</opt>>"),
    )
]

@dataclass(frozen=True)
class Automaton:
    """Moves by word and moves by any word from each state; the last state accepts."""

    label: str
    words: tuple[dict, ...]
    any_word: tuple[frozenset, ...]
    start: frozenset
    accept: int
    first_words: frozenset


def compile_template(label: str, template: str) -> Automaton:
    """Build the automaton; optional and free regions become moves without a word."""
    words: list[dict] = [{}]
    any_word: list[list[int]] = [[]]
    skips: list[list[int]] = [[]]

    def state() -> int:
        words.append({})
        any_word.append([])
        skips.append([])
        return len(words) - 1

    here, opened = 0, []
    for mark in _MARK.findall(template):
        if mark == "<<opt>>":
            opened.append(here)
        elif mark == "<</opt>>":
            skips[opened.pop()].append(here)
        elif mark.startswith("<<any:"):
            begin = here
            places = [begin]
            for _ in range(int(mark[6:-2])):
                following = state()
                any_word[here].append(following)
                here = following
                places.append(here)
            for place in places[:-1]:
                skips[place].append(here)
        else:
            following = state()
            words[here].setdefault(mark.encode(), []).append(following)
            here = following

    def closure(states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for following in skips[todo.pop()]:
                if following not in seen:
                    seen.add(following)
                    todo.append(following)
        return frozenset(seen)

    closed = [closure([s]) for s in range(len(words))]
    start = closed[0]
    return Automaton(
        label,
        tuple({w: frozenset().union(*[closed[t] for t in to]) for w, to in moves.items()} for moves in words),
        tuple(frozenset().union(*[closed[t] for t in to]) for to in any_word),
        start,
        here,
        frozenset(w for s in start for w in words[s]),
    )


def accepts(automaton: Automaton, words: list[bytes], begin: int) -> bool:
    """Whether a stretch that begins at a word is accepted."""
    states = automaton.start
    for at in range(begin, len(words)):
        following = set()
        for s in states:
            following |= automaton.words[s].get(words[at], frozenset())
            following.update(automaton.any_word[s])
        if automaton.accept in following:
            return True
        if not following:
            return False
        states = following
    return False


def mandatory(template: str) -> list[str]:
    """Words outside all optional regions, each once."""
    depth, found = 0, {}
    for mark in _MARK.findall(template):
        depth += (mark == "<<opt>>") - (mark == "<</opt>>")
        if not depth and not mark.startswith("<<"):
            found[mark] = None
    return list(found)


class LicenseScanner:
    """Base phrases and all templates over the words of a text, in one pass.

    The automata run side by side as one: its states are those of all templates,
    and at every word new runs may begin beside the open ones. Words are read one
    by one only while a run is open or where one may begin.
    """

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple] = TEMPLATES):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.words: list[dict] = []
        self.any_word: list[frozenset] = []
        self.begins: dict[bytes, frozenset] = {}
        self.accepting: dict[int, str] = {}
        for label, template in templates:
            one, base = compile_template(label, template), len(self.words)
            if any(one.any_word[s] for s in one.start):
                raise ValueError("a template begins with a word of its own")
            for moves, free in zip(one.words, one.any_word, strict=True):
                self.words.append({w: frozenset(base + t for t in to) for w, to in moves.items()})
                self.any_word.append(frozenset(base + t for t in free))
            for s in one.start:
                for word, to in self.words[base + s].items():
                    self.begins[word] = self.begins.get(word, frozenset()) | to
            self.accepting[base + one.accept] = label
        # Nothing is found in a text without a long mandatory word of some template or phrase.
        wordings = [mandatory(t) for _, t in templates] + [p.split() for p in phrases]
        self.keys = frozenset(max(words, key=len).encode() for words in wordings)
        self.first_words = frozenset(self.begins) | {phrase[0] for phrase, _ in self.phrases}

    def _labels(self, words: list[bytes], places: list[int]) -> set[str]:
        """Labels of the templates that accept some stretch; ``places`` are those of first words."""
        found, active, at = set(), frozenset(), 0
        accepting = self.accepting.keys()
        for place in places:
            if place < at:
                continue  # read while a run was open
            at, active = place, frozenset()
            while at < len(words):
                word = words[at]
                following = set(self.begins.get(word, ()))
                for state in active:
                    following.update(self.words[state].get(word, ()), self.any_word[state])
                found.update(self.accepting[s] for s in accepting & following)
                at += 1
                if not following:
                    break
                active = following
        return found

    def scan(self, text: str | None) -> tuple:
        """(n_words, n_base, first, last, base labels, labels, score)."""
        words = words_of(text)
        if self.keys.isdisjoint(words):
            return len(words), 0, None, None, "", "", 0.0
        first_words = self.first_words
        begins = [i for i, w in enumerate(words) if w in first_words]
        places, base = [], set()
        for phrase, label in self.phrases:
            found = [i for i in begins if words[i] == phrase[0] and words[i : i + len(phrase)] == phrase]
            if found:
                base.add(label)
                places += found
        by_template = self._labels(words, begins)
        # Full wording is certain; a name alone may be a mere mention.
        score = 1.0 if by_template else 0.5 if base else 0.0
        return (
            len(words),
            len(places),
            min(places) if places else None,
            max(places) if places else None,
            ",".join(sorted(base)),
            ",".join(sorted(base | by_template)),
            score,
        )


def scan_licenses(
    docs: DataFrame,
    *,
    phrases: dict[str, str] = PHRASES,
    templates: list[tuple] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    ``n_base`` counts the places of all base phrases, ``first_word`` and
    ``last_word`` are the smallest and largest word number at which one starts
    (missing where there is none). ``labels`` adds the labels of accepted
    templates. The score is 1 for a full template, 0.5 for a base phrase only,
    which may be a mere mention, else 0. Time grows with the words of a text alone.
    A missing text counts as empty; every row, repeated or not, gives one row.
    """

    def build():
        scanner = LicenseScanner(phrases, templates)
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

        def score(texts: list) -> dict:
            return dict(zip(names, zip(*map(scanner.scan, texts), strict=True), strict=True))

        return score

    arrow = {n: pa.int64() for n in ("n_words", "n_base", "first_word", "last_word")}
    arrow |= {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
    return scored_texts(
        docs,
        build,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
        arrow,
        id_col=id_col,
        text_col=text_col,
    )


def template_regex(template: str) -> str:
    """The same template as a pattern over words joined by single spaces, for SQL engines."""
    out = []
    for mark in _MARK.findall(template):
        if mark == "<<opt>>":
            out.append("(?:")
        elif mark == "<</opt>>":
            out.append(")?")
        elif mark.startswith("<<any:"):
            out.append(r"(?: [^ ]+){0," + mark[6:-2] + "}")
        else:
            out.append(" " + mark)
    return "".join(out) + " "
