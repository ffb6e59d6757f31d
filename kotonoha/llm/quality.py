"""Weak supervision of text quality: rules vote, EM weighs them.

Each rule votes good (1), bad (-1) or abstains (0) on a document, from counts
that Spark's own functions take from the whole text. No label is used: an
expectation-maximisation over the votes estimates, for every rule, how often it
votes which way on good and on bad documents, and how many documents are good.
A document is judged by its posterior probability of being good, so one weak
rule no longer rejects it and several weak ones together can.

The EM runs over the table of vote patterns, which has at most 3^rules rows
however many documents there are. Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotonoha.plans.layout import cut_lineage

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%|<>&"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REPEAT_WINDOW = 5
ITERATIONS = 15
# Votes added to each cell of a rule's table, against estimates of 0 and 1.
PRIOR_VOTES = 1.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclaims"]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def text_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, COUNTS) of every row; a missing text has no words and no lines."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    trimmed = F.btrim("_text", F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    # One pass leaves the few characters that are counted by kind.
    marks = F.regexp_replace("_text", f"[^{SYMBOLS}{CAPITALS}!]++", "")
    rows = rows.select("_id", lines.alias("_lines"), words.alias("_words"), marks.alias("_marks"))
    count = F.length("_marks")
    rows = rows.select(
        "_id",
        F.length(F.array_join("_words", "")).alias("word_chars"),
        (count - F.length(_without(F.col("_marks"), SYMBOLS))).alias("n_symbols"),
        (count - F.length(_without(F.col("_marks"), CAPITALS))).alias("n_capitals"),
        (count - F.length(_without(F.col("_marks"), "!"))).alias("n_exclaims"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    # Hash of the five words from each place on.
    following = [
        (lambda k: lambda i: F.get("_hashes", i + k))(k) for k in range(1, REPEAT_WINDOW)
    ]
    windows = F.transform("_hashes", lambda h, i: F.xxhash64(h, *[f(i) for f in following]))
    rows = rows.select(
        "_id", "word_chars", "n_symbols", "n_capitals", "n_exclaims",
        "n_lines", "n_dup_lines",
        F.size("_hashes").alias("n_words"),
        F.slice(windows, F.lit(1), F.greatest(F.size("_hashes") - (REPEAT_WINDOW - 1), F.lit(0))).alias("_windows"),
    )
    # Most texts repeat no window; only the others are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    numbered = F.sort_array(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(repeats, numbered)).drop("_windows")
    same = F.filter(
        "_sorted",
        lambda x, k: (x["w"] == F.get("_sorted", k + 1)["w"]) | (x["w"] == F.get("_sorted", k - 1)["w"]),
    )
    rows = rows.withColumn("_places", F.sort_array(F.transform(same, lambda x: x["i"]))).drop("_sorted")
    # A place covers its words up to the next place, five at most.
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, k: F.coalesce(F.least(F.get("_places", k + 1) - p, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    return rows.select(F.col("_id").alias(id_col), *[F.col(c).cast("long").alias(c) for c in COUNTS])


@dataclass(frozen=True)
class Rule:
    """SQL conditions over COUNTS under which a rule votes bad or good; else it abstains."""

    name: str
    bad: str
    good: str

    @property
    def vote(self) -> str:
        return f"CASE WHEN {self.bad} THEN -1 WHEN {self.good} THEN 1 ELSE 0 END"


RULES = (
    Rule("length", "n_words < 10", "n_words >= 40"),
    Rule(
        "word_length",
        "word_chars < 2 * n_words OR word_chars > 14 * n_words",
        "word_chars >= 3 * n_words AND word_chars <= 9 * n_words",
    ),
    Rule("symbols_by_word", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    Rule("many_symbols", "2 * n_symbols > n_words", "20 * n_symbols <= n_words"),
    Rule("symbols_by_character", "20 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    Rule("repeated_lines", "3 * n_dup_lines > n_lines", "n_dup_lines = 0"),
    Rule("repeated_words", "100 * n_repeat_words > 15 * n_words", "100 * n_repeat_words <= 2 * n_words"),
    Rule("capitals", "4 * n_capitals > word_chars", "8 * n_capitals <= word_chars"),
    Rule("exclaims", "10 * n_exclaims > n_words", "100 * n_exclaims <= n_words"),
)

BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
# Before the first step a document is good with 0.95, less 0.4 for each bad vote.
FIRST_GOOD, FIRST_STEP = 0.95, 0.4


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents and, per rule, the log ratio good : bad of each vote."""

    prior_odds: float
    ratios: tuple[dict[int, float], ...]

    def log_odds(self) -> Column:
        total = F.lit(self.prior_odds)
        for k, ratio in enumerate(self.ratios):
            vote = F.col(f"_v{k}")
            total = total + F.when(vote < 0, ratio[-1]).when(vote > 0, ratio[1]).otherwise(ratio[0])
        return total


def fit_votes(votes: DataFrame, rules: int, iterations: int = ITERATIONS) -> VoteModel | None:
    """EM over vote columns _v0, _v1, ...; None for an empty table.

    Every step is one aggregate over the pattern table; what comes back is a sum
    for each rule and vote.
    """
    names = [f"_v{k}" for k in range(rules)]
    patterns = cut_lineage(votes.groupBy(*names).agg(F.count("*").alias("_n")).coalesce(1))
    bad_votes = sum(((F.col(v) < 0).cast("int") for v in names), F.lit(0))
    good = F.greatest(F.lit(FIRST_GOOD) - FIRST_STEP * bad_votes, F.lit(1 - FIRST_GOOD))
    model = None
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(v).alias("v")) for k, v in enumerate(names)]))
    for _ in range(iterations):
        sums = (
            patterns.select("_n", good.alias("_q"), each.alias("_vote"))
            .groupBy("_vote.k", "_vote.v")
            .agg(F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("_q")).alias("good"))
            .collect()  # at most three rows for each rule
        )
        if not sums:
            return None
        cells = {(r["k"], r["v"]): (float(r["n"]), r["good"]) for r in sums}
        n = sum(c[0] for (k, _), c in cells.items() if k == 0)
        n_good = sum(c[1] for (k, _), c in cells.items() if k == 0)
        ratios = []
        for k in range(rules):
            ratio = {}
            for vote in (-1, 0, 1):
                total, in_good = cells.get((k, vote), (0.0, 0.0))
                ratio[vote] = math.log((in_good + PRIOR_VOTES) / (n_good + 3 * PRIOR_VOTES)) - math.log(
                    (total - in_good + PRIOR_VOTES) / (n - n_good + 3 * PRIOR_VOTES)
                )
            ratios.append(ratio)
        prior = math.log((n_good + PRIOR_VOTES) / (n - n_good + PRIOR_VOTES))
        model = VoteModel(prior, tuple(ratios))
        good = 1 / (1 + F.exp(-model.log_odds()))
    return model


def judge_quality(
    docs: DataFrame,
    *,
    rules: tuple[Rule, ...] = RULES,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, COUNTS, base_failed, votes, quality, kept) for every row.

    ``votes`` is a string of + - 0, a character per rule; ``quality`` the
    posterior probability of a good document. Whatever fails the base rule is
    not kept. Missing and empty texts have no words and fail it. Rows may
    repeat, ids may be missing, other columns are not read; an empty table gives
    no rows.
    """
    counts = cut_lineage(text_counts(docs, id_col=id_col, text_col=text_col))
    voted = counts.select("*", *[F.expr(r.vote).alias(f"_v{k}") for k, r in enumerate(rules)])
    model = fit_votes(voted, len(rules)) or VoteModel(0.0, ({-1: 0.0, 0: 0.0, 1: 0.0},) * len(rules))
    signs = [F.when(F.col(f"_v{k}") > 0, "+").when(F.col(f"_v{k}") < 0, "-").otherwise("0") for k in range(len(rules))]
    quality = 1 / (1 + F.exp(-model.log_odds()))
    return voted.select(
        id_col,
        *COUNTS,
        F.expr(BASE_FAILED).alias("base_failed"),
        F.concat(*signs).alias("votes"),
        quality.alias("quality"),
        (~F.expr(BASE_FAILED) & (quality >= threshold)).alias("kept"),
    )


def em_sql(counts: str, rules: tuple[Rule, ...] = RULES, iterations: int = ITERATIONS) -> str:
    """SQL of the same judgement over a relation with the id and COUNTS, as named subqueries."""
    names = [f"v{k}" for k in range(len(rules))]
    votes = ", ".join(f"{r.vote} AS {v}" for r, v in zip(rules, names, strict=True))
    bad = " + ".join(f"CASE WHEN {v} < 0 THEN 1 ELSE 0 END" for v in names)
    parts = [
        f"voted AS MATERIALIZED (SELECT *, {votes} FROM {counts})",
        f"q0 AS MATERIALIZED (SELECT {', '.join(names)}, count(*)::DOUBLE AS n, "
        f"greatest({FIRST_GOOD} - {FIRST_STEP} * ({bad}), {1 - FIRST_GOOD}) AS q FROM voted GROUP BY {', '.join(names)})",
    ]
    p = PRIOR_VOTES
    for step in range(1, iterations + 1):
        before = f"q{step - 1}"
        sums = [f"ln((sum(n * q) + {p}) / (sum(n) - sum(n * q) + {p})) AS prior"]
        for v in names:
            for tag, vote in (("m", -1), ("z", 0), ("p", 1)):
                has = f"CASE WHEN {v} = {vote} THEN n ELSE 0 END"
                sums.append(
                    f"ln((sum({has} * q) + {p}) / (sum(n * q) + {3 * p})) - "
                    f"ln((sum({has}) - sum({has} * q) + {p}) / (sum(n) - sum(n * q) + {3 * p})) AS {v}{tag}"
                )
        parts.append(f"m{step} AS MATERIALIZED (SELECT {', '.join(sums)} FROM {before})")
        odds = "prior" + "".join(f" + CASE WHEN {v} < 0 THEN {v}m WHEN {v} > 0 THEN {v}p ELSE {v}z END" for v in names)
        parts.append(
            f"q{step} AS MATERIALIZED (SELECT {', '.join(names)}, n, 1 / (1 + exp(-({odds}))) AS q FROM q0, m{step})"
        )
    same = " AND ".join(f"voted.{v} = last.{v}" for v in names)
    parts.append(
        f"judged AS (SELECT voted.*, q AS quality, ({BASE_FAILED}) AS base_failed FROM voted JOIN q{iterations} AS last ON {same})"
    )
    return ",\n".join(parts)
