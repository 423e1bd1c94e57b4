"""Queries over the given tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, or else its function name."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} exists")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
