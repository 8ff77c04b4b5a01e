"""The bound queries: columns and rows of their contracts, SQL where it can say
them.  The operators are held against brute force in the other modules."""

from __future__ import annotations

import pytest

from oracle import compare, duck
from tessera.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_line_dedup": "doc_id n_lines n_dropped n_near text_sha256",
    "op2_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_ngram_join": "doc_id class_id n_links class_size kept",
    "op4_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_url_filter": "page_id host path rule verdict trust distrust",
    "op6_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op7_mixing": "doc_id n_tokens p_clean p_low p_toxic rate copies",
    "op8_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept quality",
    "op10_language_id": "doc_id held_out lang_pred score rejected",
    "op11_whitening": "vec_id component n deviation whitened explained identity_error",
    "op12_html_extraction": "page_id url text n_chars",
    "op13_lexical_search": "item_id rank doc_id score",
}

#: The table of a query, if it isn't documents, and its result's rows for each of that table's.
TABLES = {"op5_url_filter": ("pages", 1), "op11_whitening": ("embeddings", 32), "op12_html_extraction": ("pages", 1),
          "op13_lexical_search": ("benchmark", 10)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns == COLUMNS[name].split()
    table, rows = TABLES.get(name, ("documents", 1))
    assert df.count() == rows * spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in ORACLE:
        con = duck(SF)
        _, problems = compare(df, con, ORACLE[name])
        con.close()
        assert not problems
