"""Frozen defaults for every tunable parameter.

The values mirror the published configuration of the system being
re-implemented (preparation, vectoriser, router, monitoring thresholds).
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # --- preparation -------------------------------------------------------
    min_text_length: int = 10
    # kept as a decimal string so Spark and DuckDB both do exact arithmetic
    test_fraction: str = "0.2"
    validation_fraction: str = "0.2"
    seed: int = 42
    remove_stopwords: bool = False
    # number of hash-prefix buckets used by the exact split (power of 16)
    split_bucket_hex_digits: int = 4

    # --- TF-IDF ------------------------------------------------------------
    max_features: int = 5000
    ngram_min: int = 1
    ngram_max: int = 2
    min_df: int = 2
    max_df: float = 0.8
    top_terms: int = 10

    # --- model -------------------------------------------------------------
    # the trainer uses the library default C = 1.0 (the tuned C in the
    # configuration is never passed to it); callers may pass another C
    svm_c: float = 1.0
    svm_max_iter: int = 2000
    # share of the first gradient's norm at which a problem is solved
    svm_tol: float = 1e-4
    platt_tol: float = 1e-6
    calibration_folds: int = 3
    cv_folds: int = 5
    search_trials: int = 20

    # --- requests / routing -------------------------------------------------
    request_min_chars: int = 10
    request_max_chars: int = 5000
    transformer_max_chars: int = 512
    route_max_words: int = 40
    complexity_threshold: float = 0.5
    complexity_fallback: float = 0.5
    tfidf_url: str = "http://localhost:8001"
    transformer_url: str = "http://localhost:8002"

    # --- monitoring ----------------------------------------------------------
    buffer_trim_above: int = 1000
    buffer_keep: int = 500
    rate_window: str = "5 minutes"
    rate_window_seconds: int = 300
    # the alert rules' own evaluation interval
    alert_step_seconds: int = 10

    # --- broadcast guard ----------------------------------------------------
    # a derived table is broadcast only when it has at most this many rows
    broadcast_max_rows: int = 1_000_000

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
