"""Name -> query and oracle SQL of the corpus operators."""

from __future__ import annotations

from shelfmark.llm import (
    exact_dedup,
    language_id,
    licenses,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    pieces,
    quality_model,
    quality_rules,
    ranked_search,
    secrets,
    token_counts,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_token_counts": token_counts.query,
    "op3_license_scan": licenses.query,
    "op4_secret_scan": secrets.query,
    "op5_quality_rules": quality_rules.query,
    "op6_mixing": mixing.query,
    "op7_quality_classifier": quality_model.query,
    "op8_near_dedup": near_dedup.query,
    "op9_language_id": language_id.query,
    "op10_sentencepiece": pieces.query,
    "op11_ranked_search": ranked_search.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_packing": packing.query,
}
ORACLE = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
}
