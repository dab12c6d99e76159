"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is only checked to run."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add
