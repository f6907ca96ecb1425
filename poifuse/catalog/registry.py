"""Registry of named queries: the Spark callable, its SQL twin and what it covers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(covers: str, sql: str | None = None):
    """Register under the function's name; `covers` lists operator ids of the survey."""
    def add(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        COVERS[name] = covers
        if sql is not None:
            SQL[name] = sql
        return function

    return add
