"""The registered queries of this subpackage: name -> (query, oracle SQL or None)."""

from __future__ import annotations

from deskspark.llm import (cotrain, decontam, hamming_index, hmm, importance, lang_id, license_scan, mixing, near_dup,
                           pii_bootstrap, prefix_trie, quality_rules, secret_scan)

REGISTRY = {
    "op1_decontamination": (decontam.op1_decontamination, decontam.SQL),
    "op2_hmm_score": (hmm.op2_hmm_score, None),
    "op3_secret_scan": (secret_scan.op3_secret_scan, None),
    "op4_language_id": (lang_id.op4_language_id, None),
    "op5_source_mix": (mixing.op5_source_mix, mixing.SQL),
    "op6_near_dup": (near_dup.op6_near_dup, None),
    "op7_license_scan": (license_scan.op7_license_scan, license_scan.oracle()),
    "op8_cotrain_quality": (cotrain.op8_cotrain_quality, None),
    "op9_pii_bootstrap": (pii_bootstrap.op9_pii_bootstrap, None),
    "op10_quality_rules": (quality_rules.op10_quality_rules, None),
    "op11_prefix_trie": (prefix_trie.op11_prefix_trie, prefix_trie.SQL),
    "op12_hamming_index": (hamming_index.op12_hamming_index, None),
    "op13_importance_resampling": (importance.op13_importance_resampling, importance.SQL),
}
