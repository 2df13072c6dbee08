"""The registered queries on the smallest tables."""

import os

import pytest

import compare
from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
COLUMNS = {
    "op1_toxicity": ("documents", ["doc_id", "held_out", "score", "predicted"]),
    "op2_html_extraction": ("pages", ["page_id", "url", "text", "n_chars"]),
    "op5_url_filters": ("pages", ["page_id", "host", "path", "rule", "verdict"]),
    "op6_minhash_near_dedup": ("documents", ["doc_id", "n_shingles", "component_id", "kept"]),
    "op7_suffix_array_dedup": ("documents", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "op10_quality_rules": ("documents", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]),
}


@pytest.mark.parametrize("name", ["op3_source_mixing", "op4_document_fingerprints", "op11_prefix_trie", "op12_merkle_manifest", "op13_line_dedup"])
def test_equal_to_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    outcome, _ = compare.compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert outcome.startswith("ok "), outcome


@pytest.mark.parametrize("name", COLUMNS)
def test_one_row_each(spark, name):
    table, columns = COLUMNS[name]
    got = queries()[name](spark, SF)
    assert got.columns[: len(columns)] == columns
    assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
