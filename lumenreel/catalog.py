"""All registered queries of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Adds a query and, where SQL can express it, its SQL."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from .plans import all_queries  # noqa: F401  registers

    return _QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return _SQL
