"""The operators bound to the test tables."""

from __future__ import annotations

from . import bpe, covertree, decontaminate, language, licenses, packing, pii, quality, repair, search, setsketch, shards, urls

QUERIES = {
    "op1_language": language.op1_language,
    "op2_bpe": bpe.op2_bpe,
    "op3_embedding_dedup": covertree.op3_embedding_dedup,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_near_duplicates": setsketch.op5_near_duplicates,
    "op6_url_filters": urls.op6_url_filters,
    "op7_sharding": shards.op7_sharding,
    "op8_decontamination": decontaminate.op8_decontamination,
    "op9_token_output": packing.op9_token_output,
    "op10_pii": pii.op10_pii,
    "op11_lexical_search": search.op11_lexical_search,
    "op12_quality_rules": quality.op12_quality_rules,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

ORACLES = {
    "op3_embedding_dedup": covertree.ORACLE,
    "op4_license_scan": licenses.ORACLE,
    "op5_near_duplicates": setsketch.ORACLE,
    "op6_url_filters": urls.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op11_lexical_search": search.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
}
