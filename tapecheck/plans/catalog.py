"""Registry: every query by name, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def load() -> None:
    """Import the modules that register queries."""
    from tapecheck.plans import (  # noqa: F401
        queries_aggregates,
        queries_compare,
        queries_live,
        queries_monitor,
        queries_ordering,
        queries_parsing,
        queries_sliced,
        queries_streaming,
    )

    queries_sliced.register()
