"""A small registry: a query function and, where SQL can say it, its statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.catalog.panels import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function under `name`, with the SQL it must agree with."""

    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return function

    return add


def rounded(df, digits: int = 6):
    """Every double rounded, so that summation order cannot show."""
    return df.select(
        *[
            F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )
