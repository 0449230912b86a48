"""Every registered operator query on the smallest tables: its twin where there is one, else its schema and rows."""

from __future__ import annotations

import pytest

from llm.catalog import ORACLE, QUERIES
from tests.oracle_harness import compare, duck

COLUMNS = {
    "op1_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op2_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op3_pii": ["doc_id", "text", "n_entities"],
    "op4_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_mixing": ["doc_id", "source", "lang", "topic", "tokens", "chance", "kept"],
    "op6_quality": ["doc_id", "held_out", "score", "predicted"],
    "op7_ngram_join": ["doc_id", "n_shingles", "component_id"],
    "op8_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op9_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op10_lm_scoring": ["doc_id", "n_words", "n_scored", "target_loss", "background_loss", "score"],
    "op11_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}
NATIVE = ("op3_pii", "op4_decontamination", "op8_url_filter")


def test_operators_are_registered():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.columns == COLUMNS[key]
    name = {"op2": "pages", "op8": "pages", "op9": "embeddings", "op12": "embeddings"}.get(key.split("_")[0], "documents")
    if key in NATIVE:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    if key in ORACLE:
        ok, msg = compare(df, duck(sf_dir), ORACLE[key])
        assert ok, msg
    elif key == "op11_packing":  # a row per piece
        assert df.select("doc_id").distinct().count() == spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
    elif key == "op12_whitening":  # a row per vector and component
        assert df.count() == 4 * spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
    else:
        assert df.count() == spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
