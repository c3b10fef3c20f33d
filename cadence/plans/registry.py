"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None: rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # Importing the modules registers their queries.
    import importlib
    for mod in MODULES:
        importlib.import_module(f"cadence.plans.{mod}")


MODULES = ("q_features", "q_splits", "q_models", "q_profile", "q_fitted", "q_learners", "q_experiments", "q_sources", "q_streaming")
