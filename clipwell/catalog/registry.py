"""Registry of runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipwell.catalog.bindings import Tables

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over the bound tables; ``sql`` is its independent DuckDB twin."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
