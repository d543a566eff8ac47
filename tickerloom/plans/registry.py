"""Registry of queries over the given tables, each with its SQL oracle where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
ROWS: dict[str, tuple[str, ...]] = {}


def query(name: str, covers: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query. `covers` lists the inventory rows it exercises."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        ROWS[name] = tuple(covers.split())
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
