"""The table of runnable queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.star import oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``sql`` may use the star's common table expressions."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return register


def q(expression: str, digits: int = 4) -> str:
    """The SQL counterpart of ``functions.columns.rounded``."""
    return f"round({expression} + 1e-7, {digits})"
