"""Registry of named queries and their SQL oracles.

A query is a callable ``(spark, sf_dir) -> DataFrame`` reading the driver
tables of ``sf_dir``; its oracle (when the operator is relational) is an SQL
string DuckDB runs over the same tables with identical column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


def register(name: str, ops: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``ops`` lists the inventory ids it covers."""

    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPERATORS[name] = ops
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco
