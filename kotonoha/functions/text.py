"""Text columns: trimming, safe splitting, number and noise tests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# strip() whitespace, as a Java character class under (?U). The
# control separators U+001C..U+001F count as whitespace too.
STRIP_CLASS = r"[\s\x1c-\x1f]"

# Delimiters of the safe split, most wanted first, the share of
# the window that is never searched, and the default piece length.
SPLIT_DELIMITERS = ("\n", "。", "、")
SPLIT_SEARCH_FROM = 0.9
SPLIT_MAX_LENGTH = 5000

# A whole word that is a number; a whole word that is ASCII
# punctuation or one hiragana; the mask written in place of numbers.
NUMBER_PATTERN = r"^\p{Nd}+(\.\p{Nd}+)?$"
NOISE_PATTERN = r"^([!-/:-@\[-`{-~]+|[ぁ-ん])$"
NUMBER_MASK = "[NUM]"


def strip_text(col: Column) -> Column:
    """Remove Unicode whitespace at both ends (``trim`` only knows U+0020)."""
    return F.regexp_replace(col, rf"(?U)^{STRIP_CLASS}+|{STRIP_CLASS}+$", "")


def has_content(col: Column) -> Column:
    """True where the text is neither NULL nor whitespace only."""
    return F.coalesce(F.length(strip_text(col)) > 0, F.lit(False))


def is_number(col: Column) -> Column:
    return F.coalesce(col.rlike(NUMBER_PATTERN), F.lit(False))


def is_noise(col: Column) -> Column:
    return F.coalesce(col.rlike(NOISE_PATTERN), F.lit(False))


def mask_numbers(col: Column) -> Column:
    """One replacement, so that a derived word is computed once."""
    return F.regexp_replace(col, NUMBER_PATTERN, NUMBER_MASK)


def cut_points(text: str, max_length: int) -> Iterator[int]:
    """End offset of every piece of one text."""
    begin, size = 0, len(text)
    guard = int(max_length * SPLIT_SEARCH_FROM)
    while size - begin > max_length:
        hits = (text.rfind(d, begin + guard, begin + max_length) for d in SPLIT_DELIMITERS)
        best = next((h for h in hits if h >= 0), None)
        begin = begin + max_length if best is None else best + 1
        yield begin
    if begin < size:
        yield size


def text_pieces(max_length: int = SPLIT_MAX_LENGTH):
    """Arrow UDF: text to the list of its pieces (NULL and "" give none)."""
    if max_length < 1:
        raise ValueError("max_length must be positive")

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        def cut(text):
            ends = list(cut_points(text, max_length)) if text else []
            return [text[a:b] for a, b in zip([0, *ends], ends)]

        return texts.map(cut)

    return pieces
