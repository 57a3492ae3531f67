"""Collects the queries of the catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return add


def rounded(frame: DataFrame, *columns: str) -> DataFrame:
    """Ratios to six places, as in the SQL."""
    return frame.withColumns({c: F.round(F.col(c), 6) for c in columns})


def six(column: Column) -> Column:
    return F.round(column, 6)
