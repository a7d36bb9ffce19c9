"""Registered queries: one per operator, each a Spark callable over a scale
factor's tables and, where SQL can say it, the same result in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Registers a query and, if given, its SQL twin."""
    def register(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


def once_per_application(fn: Callable) -> Callable:
    """Remembers fn(spark, *arguments) for the life of the Spark application."""
    results: dict[tuple, object] = {}

    @wraps(fn)
    def remembered(spark: SparkSession, *arguments):
        key = (spark.sparkContext.applicationId, *arguments)
        if key not in results:
            results[key] = fn(spark, *arguments)
        return results[key]

    return remembered


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    from flowlake.plans import (  # noqa: F401
        queries_clean,
        queries_evaluate,
        queries_learn,
        queries_rules,
        queries_serve,
        queries_sources,
        queries_streams,
    )
