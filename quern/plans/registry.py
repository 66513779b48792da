"""All queries of the core, with the SQL that gives the same result."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
MODULES = ("text_queries", "corpus_queries", "packing_queries", "evaluation_queries", "tokenizer_queries", "streaming_queries")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``sql`` is its equivalent over the same tables, if there is one."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"quern.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
