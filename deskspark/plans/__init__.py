"""Named queries over the driver tables, each with its DuckDB oracle SQL.

``REGISTRY[name] = (callable(spark, sf_dir) -> DataFrame, oracle_sql | None)``
"""

from __future__ import annotations

from collections.abc import Callable

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict:
    # importing the modules fills REGISTRY
    from deskspark.plans import (evaluate_q, model_q, monitor_q, prepare_q, profile_q, request_q,  # noqa: F401
                                 sink_q, stream_q, svm_q, tfidf_q)

    return REGISTRY
