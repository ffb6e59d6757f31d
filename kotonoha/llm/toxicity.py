"""Toxicity from a lexicon that tolerates misspelling and a look at the context.

A lexicon of words and word stems with weights is learned from labelled texts by
how much more often they stand in toxic ones. It becomes a trie. The trie is
intersected with Levenshtein automata: a state is a set of (trie node, edits so
far), moves are made on demand and remembered, so that nearly every word of a
text ends in the dead state after a few letters. Misspelled words are caught at
one edit from five letters on and at two from nine on; stems and shorter words
are matched exactly. The words under a stem stay in the lexicon, so a misspelled
stem is caught through them; a word is a hit of a stem or of a word, never of both.

Every hit is scored in a window of words around it: inside quotation marks or
beside a word of reporting it counts little, beside another hit or an address in
the second person it counts more. The sum and its density go through a logistic
model with three inputs, fitted on the same labelled texts.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.llm.common import column, drawn_rows, scored_texts, slices
from kotonoha.plans.layout import cut_lineage

# Labelled texts of each class that the model is fitted on.
PER_CLASS = 2000
# A term must stand in so many toxic texts of the draw, with these log odds.
MIN_TEXTS = 5
MIN_ODDS = 2.5
STEMS = range(3, 8)
WINDOW = 6
# Words whose verdict an automaton remembers, and places in its states (their number
# times their size), before it starts anew.
VERDICTS = 500_000
PLACES = 3_000_000

_EDGE = ".,;:!?\"'()[]{}<>#*$%&|~_-+=/\\“”„«»‘’…¡¿"
_QUOTES = frozenset("\"“”„«»‘’")
# Words of reporting and of address, in the languages of the texts.
REPORTING = frozenset(
    "said says quote quoted quoting wrote writes called word words term phrase sagte sagt schrieb wort zitat dit "
    "écrit mot citation dijo dice escribió palabra cita".split()
)
ADDRESS = frozenset("you your you're u ur du dich dir dein deine ihr tu toi ton vous votre tú usted eres".split())


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class TermAutomaton:
    """Words and stems of a lexicon, recognised letter by letter with edits."""

    DEAD = -1

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, tuple] = {}
        self.stem_at: dict[int, tuple] = {}
        self.edits_below = [0]
        for terms, ends in ((words, self.word_at), (stems, self.stem_at)):
            for term, weight in terms.items():
                edits = allowed_edits(term) if ends is self.word_at else 0
                node = 0
                for letter in term:
                    self.edits_below[node] = max(self.edits_below[node], edits)
                    if letter not in self.children[node]:
                        self.children[node][letter] = len(self.children)
                        self.children.append({})
                        self.edits_below.append(0)
                    node = self.children[node][letter]
                self.edits_below[node] = max(self.edits_below[node], edits)
                ends[node] = (term, weight, edits)
        # States are made on demand; ``heads`` has those after the first letters of a word.
        self._forget()

    def _closed(self, states: set) -> frozenset:
        """With letters of the term left out of the text; hopeless states dropped."""
        todo, seen = list(states), set()
        while todo:
            node, edits = todo.pop()
            if edits > self.edits_below[node] and not (edits == 0) or (node, edits) in seen:
                continue
            seen.add((node, edits))
            todo.extend((child, edits + 1) for child in self.children[node].values())
        return frozenset(seen)

    def _state(self, states: frozenset) -> int:
        if not states:
            return self.DEAD
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.places += len(states)
            self.moves.append({})
            ends = [(e, *self.word_at[n]) for n, e in states if n in self.word_at and e <= self.word_at[n][2]]
            best = min(ends, key=lambda t: (t[0], -t[2], t[1])) if ends else None
            self.found.append((best[1], best[2] * 0.7 ** best[0], best[0] > 0) if best else None)
            stems = [self.stem_at[n] for n, e in states if e == 0 and n in self.stem_at]
            self.stem.append((stems[0][0], stems[0][1], False) if stems else None)
        return self.numbers[states]

    def step(self, state: int, letter: str) -> int:
        after = self.moves[state].get(letter)
        if after is None:
            following = set()
            for node, edits in self.sets[state]:
                child = self.children[node].get(letter)
                if child is not None:
                    following.add((child, edits))
                following.add((node, edits + 1))
                following.update((c, edits + 1) for c in self.children[node].values())
            after = self._state(self._closed(following))
            if len(self.moves[state]) < 4096:  # letters of many scripts need not be remembered
                self.moves[state][letter] = after
        return after

    def match(self, word: str) -> tuple | None:
        """(term, weight, misspelled) of a lower-case word, or None; remembered per word."""
        if (found := self.verdicts.get(word, 0)) == 0:
            if len(self.verdicts) >= VERDICTS or self.places >= PLACES:
                self._forget()
            found = self.verdicts[word] = self._match(word)
        return found

    def _forget(self) -> None:
        """Verdicts and states go, so that memory stays bounded on any text."""
        self.verdicts: dict[str, tuple | None] = {}
        self.heads: dict[str, int] = {}
        self.sets: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.found: list[tuple | None] = []
        self.stem: list[tuple | None] = []
        self.places = 0
        self.start = self._state(self._closed({(0, 0)}))

    def _match(self, word: str) -> tuple | None:
        head = word[:3]
        state = self.heads.get(head, -2)
        if state == -2:
            state = self.start
            for letter in head:
                state = self.step(state, letter)
                if state == self.DEAD or self.stem[state]:
                    break
            if len(self.heads) < 500_000:
                self.heads[head] = state
        if state == self.DEAD:
            return None
        for letter in word[3:]:
            if self.stem[state]:
                return self.stem[state]
            state = self.step(state, letter)
            if state == self.DEAD:
                return None
        return self.found[state] or self.stem[state]


@dataclass(frozen=True)
class ToxicityModel:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    harmless: frozenset = frozenset()
    # Intercept and coefficients of inputs(); this one calls nothing toxic.
    coefficients: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)


def inputs(weight: float, n_words: int) -> tuple[float, ...]:
    """1, whether there is a hit, its weight, its density."""
    return 1.0, float(weight > 0), math.log1p(weight), math.log1p(100 * weight / max(1, n_words))


def _quoted(words: list[str], at: int) -> bool:
    """Whether quotation marks open before and close after a word, inside the window."""
    low, high = max(0, at - WINDOW), min(len(words), at + WINDOW + 1)
    opened = any(w[0] in _QUOTES for w in words[low : at + 1])
    return opened and any(w.rstrip(".,;:!?")[-1:] in _QUOTES for w in words[at:high])


def hits(text: str | None, automaton: TermAutomaton, harmless: frozenset) -> tuple[int, dict]:
    """(number of words, weight by (word, misspelled)) of a text, with context."""
    words = (text or "").lower().split()
    matched = {}
    for word in set(words):
        bare = word.strip(_EDGE)
        found = automaton.match(bare)
        if found and bare not in harmless:
            matched[word] = (bare, found)
    if not matched:
        return len(words), {}
    places = [i for i, w in enumerate(words) if w in matched]
    weights: dict[tuple, float] = {}
    for k, at in enumerate(places):
        bare, (_, weight, misspelled) = matched[words[at]]
        low, high = max(0, at - WINDOW), at + WINDOW + 1
        around = [w.strip(_EDGE) for w in words[low:at] + words[at + 1 : high]]
        beside = (k > 0 and at - places[k - 1] <= WINDOW) or (k + 1 < len(places) and places[k + 1] - at <= WINDOW)
        if _quoted(words, at) or not REPORTING.isdisjoint(around) and not beside:
            weight *= 0.3
        elif beside or not ADDRESS.isdisjoint(around):
            weight *= 1.2
        weights[bare, misspelled] = weights.get((bare, misspelled), 0.0) + weight
    return len(words), weights


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, toxic, n): texts of each class by word ("=word") and stem ("^stem")."""

    def run(batches):
        for batch in slices(batches):
            counts: Counter = Counter()
            for text, toxic in zip(column(batch, "_text"), column(batch, "_toxic"), strict=True):
                terms = set()
                for word in set((text or "").lower().split()):
                    bare = word.strip(_EDGE)
                    if len(bare) > 2:
                        terms.add("=" + bare)
                        terms.update("^" + bare[:n] for n in STEMS if n < len(bare))
                counts.update((t, toxic) for t in terms)
            if counts:
                keys = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([t for t, _ in keys]),
                        pa.array([y for _, y in keys], pa.int32()),
                        pa.array(list(counts.values()), pa.int64()),
                    ],
                    names=["term", "toxic", "n"],
                )

    return texts.mapInArrow(run, "term string, toxic int, n long")


def choose_terms(rows: list[tuple], positives: int, negatives: int) -> tuple[dict, dict]:
    """Words and stems with weights, from (term, toxic texts, other texts) rows."""
    odds = {}
    support = {}
    for term, toxic, other in rows:
        value = math.log((toxic + 0.5) / (positives + 1)) - math.log((other + 0.5) / (negatives + 1))
        if value >= MIN_ODDS:
            odds[term], support[term] = value, toxic
    words = {t[1:] for t in odds if t[0] == "="}
    stems = [t[1:] for t in odds if t[0] == "^"]
    # Texts of the most frequent word, and of the most frequent longer stem, by its first letters.
    word_texts: dict[str, int] = {}
    stem_texts: dict[str, int] = {}
    for w in words:
        for n in STEMS:
            if n <= len(w):
                word_texts[w[:n]] = max(word_texts.get(w[:n], 0), support["=" + w])
    for s in stems:
        for n in range(STEMS.start, len(s)):
            stem_texts[s[:n]] = max(stem_texts.get(s[:n], 0), support["^" + s])
    kept: set[str] = set()
    for stem in sorted(stems, key=lambda s: (len(s), s)):
        total = support["^" + stem]
        # A stem that is mostly one word is left to that word.
        if word_texts.get(stem, 0) >= 0.8 * total:
            continue
        # Of a chain of stems in the same texts the longest one is kept.
        if stem_texts.get(stem, 0) >= 0.98 * total:
            continue
        if not any(stem[:n] in kept for n in STEMS):
            kept.add(stem)
    # Words under a stem stay for their misspellings; an exact one is a hit of the stem alone.
    weight = {t: min(1.5, odds[t] / 5) for t in odds}
    return {w: weight["=" + w] for w in sorted(words)}, {s: weight["^" + s] for s in sorted(kept)}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Newton steps for weighted logistic regression."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * w[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - ridge * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(beta.tolist())


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    per_class: int = PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Lexicon and logistic model from at most about ``per_class`` labelled texts of each class.

    Labels are drawn by a hash of the id, as many of each class; an id with both
    labels counts as both. Equal texts count once. Without labels of either class the model finds nothing.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic"), F.xxhash64(id_col).alias("_draw")
    )
    drawn = cut_lineage(drawn_rows(known, "_toxic", "_draw", per_class).select("_id", "_toxic").distinct())
    total = {r["_toxic"]: r["_n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("_n")).collect()}
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    labelled = cut_lineage(texts.join(F.broadcast(drawn), "_id").select("_toxic", "_text", F.xxhash64("_text").alias("_draw")))
    # Ids may have any number of rows: equal texts count once, and a second draw by hash of the text bounds the others.
    sample = cut_lineage(drawn_rows(labelled, "_toxic", "_draw", per_class).select("_toxic", "_text").distinct())
    size = {r["_toxic"]: r["_n"] for r in sample.groupBy("_toxic").agg(F.count("*").alias("_n")).collect()}
    if len(size) < 2:
        return ToxicityModel()
    positives, negatives = size[1], size[0]
    both = term_counts(sample).groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q"),
    )
    # Odds first, so that only telling terms reach the driver.
    share = (F.col("p") + 0.5) / (positives + 1) / ((F.col("q") + 0.5) / (negatives + 1))
    rows = both.where((F.col("p") >= MIN_TEXTS) & (share >= math.exp(MIN_ODDS))).collect()
    words, stems = choose_terms([tuple(r) for r in rows], positives, negatives)

    def run(batches):
        automaton = TermAutomaton(words, stems)
        for batch in slices(batches):
            found = [hits(t, automaton, frozenset()) for t in column(batch, "_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([[w for w, m in h if not m] for _, h in found], pa.list_(pa.string())),
                    pa.array([[w for w, m in h if m] for _, h in found], pa.list_(pa.string())),
                    pa.array([sum(v for (_, m), v in h.items() if not m) for _, h in found], pa.float64()),
                    pa.array([[v for (_, m), v in h.items() if m] for _, h in found], pa.list_(pa.float64())),
                ],
                names=["toxic", "n", "exact", "near", "weight", "near_weights"],
            )

    seen = (
        sample.select("_toxic", "_text")
        .mapInArrow(
            run,
            "toxic int, n long, exact array<string>, near array<string>, weight double, near_weights array<double>",
        )
        .drop("exact")
        .collect()
    )
    near = {y: Counter(w for r in seen if r["toxic"] == y for w in r["near"]) for y in (0, 1)}
    harmless = frozenset(w for w, n in near[0].items() if n / negatives >= 0.2 * near[1][w] / positives)
    x = np.array(
        [
            inputs(r["weight"] + sum(v for w, v in zip(r["near"], r["near_weights"], strict=True) if w not in harmless), r["n"])
            for r in seen
        ]
    )
    y = np.array([r["toxic"] for r in seen], float)
    # Back to the shares that the labels have before the draw.
    weight = np.where(y == 1, total[1] / positives, total[0] / negatives)
    weight *= len(y) / weight.sum()
    return ToxicityModel(words, stems, harmless, fit_logistic(x, y, weight))


# The automaton of a worker's last model: its states are worth keeping between tasks.
_AUTOMATA: dict[str, TermAutomaton] = {}


def _automaton(name: str, model: ToxicityModel) -> TermAutomaton:
    """Automaton of a model, told apart by a name that no other model ever has."""
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[name] = TermAutomaton(model.words, model.stems)
    return _AUTOMATA[name]


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted, n_hits, terms) for every row, from the whole text alone.

    ``predicted`` is 1 from a score of 0.5 on; ``n_hits`` counts distinct hit
    words, ``terms`` lists them. Missing and empty texts get the score of a text
    without hits. Rows may repeat, ids may be missing, other columns are not read.
    """

    name = uuid.uuid4().hex

    def build():
        automaton = _automaton(name, model)

        def score(texts: list) -> dict:
            scores, terms = [], []
            for text in texts:
                n, found = hits(text, automaton, model.harmless)
                value = sum(c * v for c, v in zip(model.coefficients, inputs(sum(found.values()), n), strict=True))
                scores.append(1 / (1 + math.exp(-min(30.0, max(-30.0, value)))))
                terms.append(sorted({w for w, _ in found}))
            return {
                "score": scores,
                "predicted": [int(s >= 0.5) for s in scores],
                "n_hits": [len(t) for t in terms],
                "terms": terms,
            }

        return score

    return scored_texts(
        docs, build, "score double, predicted int, n_hits int, terms array<string>",
        {"score": pa.float64(), "predicted": pa.int32(), "n_hits": pa.int32(), "terms": pa.list_(pa.string())},
        id_col=id_col, text_col=text_col,
    )
