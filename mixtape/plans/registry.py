"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB oracle (omit for non-SQL ops)."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return wrap


def queries() -> dict[str, QueryFn]:
    from mixtape.plans import checks as _  # noqa: F401  (registers on import, and queries with it)
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from mixtape.plans import checks as _  # noqa: F401
    return dict(_ORACLE)
