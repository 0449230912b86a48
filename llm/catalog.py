"""Registered queries of the operators, with DuckDB twins where SQL can express them."""

from __future__ import annotations

from llm import op1_substring_dedup as op1
from llm import op2_html_extraction as op2
from llm import op3_pii as op3
from llm import op4_decontamination as op4
from llm import op5_mixing as op5
from llm import op6_quality as op6
from llm import op7_ngram_join as op7
from llm import op8_url_filter as op8
from llm import op9_embedding_dedup as op9
from llm import op10_lm_scoring as op10
from llm import op11_packing as op11
from llm import op12_whitening as op12
from llm import op13_merkle_manifest as op13

QUERIES = {
    "op1_substring_dedup": op1.op1_substring_dedup,
    "op2_html_extraction": op2.op2_html_extraction,
    "op3_pii": op3.op3_pii,
    "op4_decontamination": op4.op4_decontamination,
    "op5_mixing": op5.op5_mixing,
    "op6_quality": op6.op6_quality,
    "op7_ngram_join": op7.op7_ngram_join,
    "op8_url_filter": op8.op8_url_filter,
    "op9_embedding_dedup": op9.op9_embedding_dedup,
    "op10_lm_scoring": op10.op10_lm_scoring,
    "op11_packing": op11.op11_packing,
    "op12_whitening": op12.op12_whitening,
    "op13_merkle_manifest": op13.op13_merkle_manifest,
}
ORACLE = {
    "op1_substring_dedup": op1.ORACLE,
    "op4_decontamination": op4.ORACLE,
    "op5_mixing": op5.ORACLE,
    "op8_url_filter": op8.ORACLE,
    "op13_merkle_manifest": op13.ORACLE,
}
