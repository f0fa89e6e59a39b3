"""Named queries, each with SQL of the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; the first registration of a name stands, a second one is an error."""

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add
