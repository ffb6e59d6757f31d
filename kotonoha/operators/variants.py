"""Ready-made derived token tables: filtered, surface and hybrid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kotonoha.functions import text as text_fn
from kotonoha.functions.words import form_from_info, is_variant
from kotonoha.operators.filters import filter_tokens

# Parts of speech named by the three variants.
POS_BLANK = "空白"
FILTERED_DROP = ("空白", "補助記号", "記号")
HYBRID_DROP = ("空白", "補助記号", "記号", "感動詞")
HYBRID_KEEP_FORM = ("名詞", "形状詞", "接尾辞", "接頭辞")

# Training window of each variant.
VARIANT_WINDOWS = {"filtered": 5, "surface": 10, "hybrid": 10}


def mask_number_words(tokens: DataFrame) -> DataFrame:
    return tokens.withColumn("word", text_fn.mask_numbers(F.col("word")))


def filtered_variant(tokens: DataFrame) -> DataFrame:
    """No symbols or blanks, numbers masked, punctuation-only and one-kana words gone."""
    kept = mask_number_words(filter_tokens(tokens, pos_exclude=FILTERED_DROP, strict=False))
    return kept.where(~text_fn.is_noise(F.col("word")))


def _surface(tokens: DataFrame):
    variant = is_variant(tokens, "token_info")
    return form_from_info(F.col("token_info"), F.col("word"), "surface", variant)


def surface_variant(tokens: DataFrame) -> DataFrame:
    """Words as written; only blanks dropped."""
    return filter_tokens(tokens.withColumn("word", _surface(tokens)), pos_exclude=POS_BLANK, strict=False)


def hybrid_variant(tokens: DataFrame) -> DataFrame:
    """Content words keep their form, all others go back to the surface; numbers masked."""
    kept = filter_tokens(tokens, pos_exclude=HYBRID_DROP, strict=False)
    content = F.coalesce(F.col("pos").isin(*HYBRID_KEEP_FORM), F.lit(False))
    word = F.when(content, F.col("word")).otherwise(_surface(tokens))
    return mask_number_words(kept.withColumn("word", word))


def surface_only(tokens: DataFrame) -> DataFrame:
    """The columns that the variants read; token_info keeps a surface other than the word, and nothing else."""
    surface = F.col("_surface")
    info = F.when(~surface.eqNullSafe(F.col("word")), F.to_json(F.struct(surface.alias("surface"))))
    # A column of its own first, or the JSON would be read twice.
    rows = tokens.withColumn("_surface", _surface(tokens))
    return rows.select("doc_id", "token_id", "word", "pos", info.alias("token_info"))


VARIANTS = {
    "filtered": filtered_variant,
    "surface": surface_variant,
    "hybrid": hybrid_variant,
}
