"""Operators that prepare text corpora for training, and their queries.

Nothing else in the package imports this subpackage. ``load`` registers the queries.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if it has one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def load() -> None:
    from . import decontaminate, hash_tree, mixing, near_dup, pu_toxicity, quality_rules, secret_scan, spelling, suffix_dedup, token_files, url_filter, vector_dedup, word_runs  # noqa: F401
