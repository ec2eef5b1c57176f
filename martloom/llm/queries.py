"""Registered queries of this subpackage."""

from __future__ import annotations

from martloom.llm import collocations, embedding_dedup, line_dedup, near_dedup
from martloom.llm.collocations import op13_collocations
from martloom.llm.embedding_dedup import op4_embedding_near_dedup
from martloom.llm.fingerprints import op5_document_fingerprints
from martloom.llm.language_id import op6_language_id
from martloom.llm.licenses import op2_license_scan
from martloom.llm.line_dedup import op10_line_dedup
from martloom.llm.mixing import op9_source_mixing
from martloom.llm.near_dedup import op3_minhash_near_dedup
from martloom.llm.packing import op7_best_fit_packing
from martloom.llm.periodic_runs import op11_periodic_runs
from martloom.llm.quality import op8_quality_classifier
from martloom.llm.quality_rules import op12_quality_rules
from martloom.llm.substring_dedup import op1_suffix_array_dedup

QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_language_id": op6_language_id,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_source_mixing": op9_source_mixing,
    "op10_line_dedup": op10_line_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_rules": op12_quality_rules,
    "op13_collocations": op13_collocations,
}

#: SQL over the same tables that must give the same rows, where SQL can say it.
ORACLES: dict[str, str] = {
    "op3_minhash_near_dedup": near_dedup.ORACLE_SQL,
    "op4_embedding_near_dedup": embedding_dedup.ORACLE_SQL,
    "op10_line_dedup": line_dedup.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
