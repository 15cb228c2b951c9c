"""Query registry: name -> (Spark builder, optional oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that they register."""
    from foldsafe.plans import (  # noqa: F401
        flagship, q_sources, q_scalars, q_filters, q_joins, q_aggregates,
        q_splits, q_prep, q_knn, q_curves, q_search, q_learners, q_scoring, q_streaming, q_text,
    )
