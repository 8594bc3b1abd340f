"""All queries of the engine and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _all() -> None:
    from . import queries  # noqa: F401  registers them


def queries() -> dict[str, Query]:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_SQL)
