"""The registered queries of the operators and their SQL.

Each query applies its operator to the whole table with production parameters
and derives the digest columns from what the operator returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kotonoha.llm import (
    align,
    binpack,
    decontaminate,
    html,
    langid,
    licenses,
    lines,
    packing,
    quality,
    sharding,
    simhash,
    toxicity,
    vectorcodes,
)
from kotonoha.llm.common import fold, table

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(fold("doc_id", 4) != 2))
    found = langid.identify(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(table(spark, folder, "documents"), shards=40)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract_pages(table(spark, folder, "pages"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels.where(fold("doc_id", 5) != 0))
    found = toxicity.score_toxicity(docs, model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = vectorcodes.compress_vectors(table(spark, folder, "embeddings"), carry=["label"])
    rows = vectorcodes.with_group_sum(found.rows, "label", "error", "label_error")
    return rows.select(
        "vec_id", "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256")
    )


def op12_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return binpack.pack_best_fit(table(spark, folder, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.align_tokenizers(
        table(spark, folder, "documents"),
        public_tokenizers.path(BYTE_TOKENIZER),
        public_tokenizers.path(PIECE_TOKENIZER),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_quality_rules,
        op3_packing,
        op4_simhash,
        op5_sharding,
        op6_line_dedup,
        op7_decontamination,
        op8_license_scan,
        op9_html_extraction,
        op10_toxicity,
        op11_vector_codes,
        op12_best_fit,
        op13_alignment,
        pipeline,
    )
}

# SQL texts: A-Z in lower case and nothing else, words of either kind.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE_WORDS = r"[^\x20\x09-\x0D]+"
_PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_OP2_COUNTS = rf"""
base AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_SPACE_WORDS}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{_SPACE_WORDS}')) AS ls
  FROM documents),
grams AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM (
    SELECT r, i, ws[i : i + 4] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM base))),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM grams, range(0, 5) AS o(k) WHERE n > 1 GROUP BY r),
counts AS MATERIALIZED (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_exclaims
  FROM base LEFT JOIN repeated USING (r))"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _shingles(source: str, key: str) -> str:
    """Distinct five-word runs; a text of fewer words is one run."""
    return rf"""
  SELECT DISTINCT {key}, g FROM (
    SELECT {key}, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i : i + 4] END AS g FROM (
      SELECT {key}, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM (
        SELECT {key}, regexp_extract_all({_LOWER}, '{_PLAIN_WORDS}') AS ws FROM {source}) WHERE len(ws) > 0))"""


_OP8_PLACES = " UNION ALL ".join(
    f"""SELECT doc_id, r, i - 1 AS place, '{label}' AS label FROM (
        SELECT doc_id, r, ws, unnest(range(1, len(ws) + 1)) AS i FROM base WHERE contains(joined, ' {phrase} '))
      WHERE ws[i : i + {len(phrase.split()) - 1}] = ['{"', '".join(phrase.split())}']"""
    for phrase, label in licenses.PHRASES.items()
)
_OP8_TEMPLATES = " UNION ALL ".join(
    f"SELECT r, '{label}' AS label FROM base WHERE regexp_matches(joined, '{licenses.template_regex(template)}')"
    for label, template in licenses.TEMPLATES
)

ORACLES = {
    "op2_quality_rules": f"""
      WITH {_OP2_COUNTS}, {quality.em_sql("counts")}
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
             NOT base_failed AND quality >= 0.5 AS kept FROM judged""",
    "op6_line_dedup": f"""
      WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
      cut AS (SELECT r, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM rows),
      keyed AS (SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut),
      often AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
      SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE often.key IS NOT NULL) AS n_dropped,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE often.key IS NULL), '')) AS kept_sha256
      FROM keyed LEFT JOIN often USING (key) GROUP BY r""",
    "op7_decontamination": f"""
      WITH d AS ({_shingles("documents", "doc_id")}), b AS ({_shingles("benchmark", "item_id")}),
      sizes AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id)
      SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*)::DOUBLE / n AS containment
      FROM d JOIN b USING (g) JOIN sizes USING (item_id) GROUP BY doc_id, item_id, n HAVING 10 * count(*) >= 8 * n""",
    "op8_license_scan": rf"""
      WITH base AS (
        SELECT doc_id, r, ws, ' ' || array_to_string(ws, ' ') || ' ' AS joined FROM (
          SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER}, '{_PLAIN_WORDS}') AS ws FROM documents)),
      places AS ({_OP8_PLACES}),
      found AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                       string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
      templates AS (SELECT DISTINCT r, label FROM ({_OP8_TEMPLATES})),
      labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
                   FROM (SELECT r, label FROM templates UNION ALL SELECT r, label FROM places) GROUP BY r)
      SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
             coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
             CASE WHEN r IN (SELECT r FROM templates) THEN 1.0 WHEN n_base > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
      FROM base LEFT JOIN found USING (r) LEFT JOIN labelled USING (r)""",
}
