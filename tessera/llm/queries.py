"""The operators bound to the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (exact_dedup, html_text, language, lexical, line_dedup, lm, mixing, ngram_join, piece_bpe, quality,
                         token_counts, url_filter, whitening)
from tessera.llm.common import scratch_path
from tessera.sources.tables import table

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", "n_near", F.sha2("cleaned", 256).alias("text_sha256"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


# The rules of the URL filter: host and path, verdict.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts through a cache that starts empty, so that the query always does
    its whole work; name a lasting folder in `spark.tessera.token.cache` to
    keep counts between runs."""
    cache = spark.conf.get("spark.tessera.token.cache", "") or scratch_path(spark, "token-cache")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_MODEL), cache)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best language also where the operator rejects it for a narrow
    margin: the score is then under 0.5 and `rejected` is set."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_ngram_join": op3_ngram_join,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_url_filter": op5_url_filter,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_whitening": op11_whitening,
    "op12_html_extraction": op12_html_extraction,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE = {
    "op8_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST)""",
    "op13_lexical_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
        i AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark WHERE text IS NOT NULL),
        wanted AS (SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
        n AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS terms FROM d WHERE len(t) > 0),
        posting AS (SELECT r, doc_id, len, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS len, unnest(t) AS term FROM d)
                    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        weight AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM posting, n GROUP BY term),
        impact AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len * docs) // terms))) AS x
                   FROM posting JOIN weight USING (term), n),
        scored AS (SELECT q, item_id, r, doc_id, sum(times * x)::BIGINT AS score FROM wanted JOIN impact USING (term) GROUP BY ALL),
        placed AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10""",
}
