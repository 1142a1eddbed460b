"""Registry of named queries, each with its check SQL where SQL can express the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its check SQL."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def load_all() -> None:
    """Import every module that registers queries."""
    from flowlab.plans import (  # noqa: F401
        queries_clean,
        queries_features,
        queries_io,
        queries_metrics,
        queries_models,
        queries_profile,
        queries_streams,
    )
