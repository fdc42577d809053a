"""The thin queries over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arealis.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.quality_model import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.line_dedup import line_dedup

    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_deleted", "text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.html_extract import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.embedding_dedup import embedding_near_dedup

    return embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arealis.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OPERATORS = (
    op1_quality_rules,
    op2_quality_classifier,
    op3_bpe_encode_decode,
    op4_line_dedup,
    op5_token_counts,
    op6_html_extraction,
    op7_ngram_jaccard,
    op8_embedding_near_dedup,
    op9_best_fit_packing,
    op10_toxicity,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


_WORD = r"[^\x20\x09-\x0D]"

#: n_repeat_words: a word counts if one of the five windows over it has a key that occurs twice in its text.
_RULES_SQL = rf"""
WITH docs AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         list_filter(string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(COALESCE(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i+4], ' ') AS win
  FROM (SELECT doc_id, words, UNNEST(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) >= 5)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, COUNT(*) AS n_repeat_words
  FROM (SELECT DISTINCT doc_id, i + d AS i FROM repeated, (SELECT UNNEST(range(5)) AS d)) GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(words, lambda w: w IN (@STOP@))) AS BIGINT) AS n_stop_words,
         CAST(len(lines) AS BIGINT) AS n_lines
  FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND @RULES@ AS kept,
       n_stop_words, n_lines
FROM counts
"""

# How the SQL writes each measure of the threshold table.
_MEASURES_SQL = {
    "symbol_ratio": "n_symbols / greatest(n_words, 1)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "stop_ratio": "n_stop_words / greatest(n_words, 1)",
    "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
}


def llm_oracle_sql() -> dict[str, str]:
    """Only the rules can be written in SQL; the other operators have brute-force tests."""
    from arealis.llm.quality_rules import RULES, STOP_WORDS

    rules = " AND ".join(f"{_MEASURES_SQL[m]} {'>=' if side == 'min' else '<='} {t}" for m, side, t in RULES.values())
    words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return {"op1_quality_rules": _RULES_SQL.replace("@STOP@", words).replace("@RULES@", f"({rules})")}

