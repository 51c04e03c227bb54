"""Named queries over the supplied tables, each with equivalent plain SQL.

A query is a function of (spark, sf_dir). Where plain SQL can state the same
result, it is registered with the query and used to check it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def load() -> None:
    from . import corpus, series, social, streams, telemetry, text  # noqa: F401
