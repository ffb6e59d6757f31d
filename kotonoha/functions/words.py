"""Token columns: word class by script, word forms, coarse part of speech."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

# Fixed values of the built-in script tokenizer. A token is a run of letters of
# one script (Han, hiragana, katakana, everything else), a number, or a single
# other character; whitespace is never a token. The ranges decide ASCII first,
# since a script is looked up by a search in a table.
SCRIPT_PATTERN = (
    r"[A-Za-z[[\x{80}-\x{10ffff}]&&[\p{L}\p{M}]&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]]]+"
    r"|[[\x{80}-\x{10ffff}]&&\p{IsHan}]+"
    r"|[[\x{80}-\x{10ffff}]&&\p{IsHiragana}]+"
    r"|[[\x{80}-\x{10ffff}]&&[\p{IsKatakana}ー]]+"
    r"|\p{Nd}+(?:\.\p{Nd}+)?"
    r"|[^\p{L}\p{M}\p{Nd}\p{IsWhite_Space}\x1c-\x1f]"
)
POS_WORD, POS_NUMBER, POS_SYMBOL = "word", "number", "symbol"

# Accepted spellings of the three word forms, and the keys under
# which tokenizers store them in token_info.
FORM_ALIASES = {
    "dictionary": "dictionary", "dict": "dictionary", "base": "dictionary", "lemma": "dictionary",
    "surface": "surface", "orig": "surface", "original": "surface",
    "normalized": "normalized", "normal": "normalized", "norm": "normalized",
}
FORM_KEYS = {
    "dictionary": ("dictionary_form", "base_form"),
    "surface": ("surface",),
    "normalized": ("normalized_form",),
}
# Stands in a stored list for the token_info that ``script_info`` gives for the token's own
# word and pos; any other one that begins with the mark is stored behind a second mark.
INFO_MARK = "\x00"
# token_info as ``script_info`` writes it, nothing escaped: its forms are read
# without parsing JSON. The form asked for becomes the group.
PLAIN_KEYS = ("surface", "dictionary_form", "normalized_form")
PLAIN_CHARS = r'[^"\\\x00-\x1f]'


def resolve_form(word_form: str | None, use_base_form: bool = True) -> str:
    """Canonical form name; ValueError for an unknown spelling."""
    if word_form is None:
        return "dictionary" if use_base_form else "surface"
    try:
        return FORM_ALIASES[str(word_form).lower()]
    except KeyError:
        raise ValueError(
            f"unknown word_form {word_form!r}; use dictionary, surface or normalized"
        ) from None


def script_words(text: Column) -> Column:
    """Token strings of a text, in order; NULL text gives NULL."""
    return F.regexp_extract_all(text, F.lit(SCRIPT_PATTERN), F.lit(0))


def script_pos(surface: Column) -> Column:
    """Word class of a script token, decided by its first character; ASCII by comparison alone."""
    first = F.substring(surface, 1, 1)
    return (
        F.when(first.between("a", "z") | first.between("A", "Z"), F.lit(POS_WORD))
        .when(first.between("0", "9"), F.lit(POS_NUMBER))
        .when(first < "\x80", F.lit(POS_SYMBOL))
        .when(first.rlike(r"[\p{L}\p{M}]"), F.lit(POS_WORD))
        .when(first.rlike(r"\p{Nd}"), F.lit(POS_NUMBER))
        .otherwise(F.lit(POS_SYMBOL))
    )


def script_form(surface: Column, form: str) -> Column:
    """The script tokenizer has no dictionary: only "normalized" changes the word."""
    return F.lower(surface) if form == "normalized" else surface


def script_info(surface: Column, pos: Column) -> Column:
    """token_info as JSON text; only a symbol that is no plain ASCII character can need escaping."""
    plain = surface.between("!", "~") & ~surface.isin('"', "\\")
    escaped = F.to_json(
        F.struct(
            surface.alias("surface"),
            surface.alias("dictionary_form"),
            F.lower(surface).alias("normalized_form"),
            F.array(pos).alias("pos_detail"),
        )
    )
    parts = [
        F.lit('{"surface":"'), surface, F.lit('","dictionary_form":"'), surface,
        F.lit('","normalized_form":"'), F.lower(surface), F.lit('","pos_detail":["'), pos, F.lit('"]}'),
    ]
    return F.when((pos == POS_SYMBOL) & ~plain, escaped).otherwise(F.concat(*parts))


def packed_info(info: Column, word: Column, pos: Column) -> Column:
    """token_info as it is stored beside its word and pos; ``unpacked_info`` gives it back."""
    return (
        F.when(info == script_info(word, pos), F.lit(INFO_MARK))
        .when(F.startswith(info, F.lit(INFO_MARK)), F.concat(F.lit(INFO_MARK), info))
        .otherwise(info)
    )


def unpacked_info(info: Column, word: Column, pos: Column) -> Column:
    return (
        F.when(info == INFO_MARK, script_info(word, pos))
        .when(F.startswith(info, F.lit(INFO_MARK)), F.substring(info, 2, 2147483647))
        .otherwise(info)
    )


def with_info(tokens: Column, change: Callable[[Column, Column, Column], Column]) -> Column:
    """A token list whose token_info is changed by ``packed_info`` or ``unpacked_info``."""

    def changed(token: Column) -> Column:
        names = ("token_id", "word", "pos")
        info = change(token["token_info"], token["word"], token["pos"])
        return F.struct(*[token[n].alias(n) for n in names], info.alias("token_info"))

    return F.transform(tokens, changed)


def script_info_variant(surface: Column, pos: Column) -> Column:
    """token_info as VARIANT: no JSON is written, and none parsed when it is read."""
    return F.to_variant_object(
        F.struct(
            surface.alias("surface"),
            surface.alias("dictionary_form"),
            F.lower(surface).alias("normalized_form"),
            F.array(pos).alias("pos_detail"),
        )
    )


def is_variant(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VariantType)


def read_info(info: Column, path: str, variant: bool = False) -> Column:
    """A value of token_info as text, from JSON text or from a VARIANT; NULL where there is none."""
    return F.try_variant_get(info, path, "string") if variant else F.get_json_object(info, path)


def form_from_info(info: Column, word: Column, word_form: str, variant: bool = False) -> Column:
    """Re-select the word form from token_info; unreadable info keeps the word."""
    keys = FORM_KEYS[resolve_form(word_form)]
    found = [read_info(info, f"$.{k}", variant) for k in keys]
    if not variant:
        plain = F.regexp_extract_all(info, F.lit(plain_pattern(keys[0])), F.lit(1))
        found = [F.get(plain, F.lit(0)), *found]
    return F.coalesce(*found, word)


def plain_pattern(key: str) -> str:
    """Matches only a whole token_info of the layout above whose value of ``key`` is not empty."""
    values = [f"({PLAIN_CHARS}+)" if k == key else f"{PLAIN_CHARS}*" for k in PLAIN_KEYS]
    pairs = ",".join(f'"{k}":"{v}"' for k, v in zip(PLAIN_KEYS, values))
    return rf'^\{{{pairs},"pos_detail":\["{PLAIN_CHARS}*"\]\}}\z'


def coarse_pos(detail: Column) -> Column:
    """First component of a comma-joined part of speech."""
    return F.split(detail, ",", 2)[0]


def coarse_pos_from_info(info: Column, variant: bool = False) -> Column:
    return read_info(info, "$.pos_detail[0]", variant)


def as_name_list(names: str | Iterable[str] | None) -> list[str]:
    """A string is one name, not a sequence of characters; None is empty."""
    if names is None:
        return []
    if isinstance(names, str):
        return [names]
    return sorted(set(names))
