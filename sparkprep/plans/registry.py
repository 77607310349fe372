"""Where queries register themselves with the SQL that must agree with them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkprep.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its DuckDB equivalent where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
