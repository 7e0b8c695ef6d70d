"""Where queries are registered, each next to the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalogue.checks import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(check: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``check`` is the comparison SQL, None where there is none."""

    def register(function: Query) -> Query:
        label = name or function.__name__
        if label in QUERIES:
            raise ValueError(f"query {label} is registered twice")
        QUERIES[label] = function
        if check is not None:
            ORACLES[label] = sql(check)
        return function

    return register
