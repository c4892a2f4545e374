"""Collects queries under their ids, each with an independent SQL statement that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def register(name: str, check: str | None, *, query: Query) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = query
    if check is not None:
        CHECKS[name] = check


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        register(name, check, query=function)
        return function

    return add
