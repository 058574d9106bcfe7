"""Registry of named queries: each a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in plain SQL, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.fixtures import load, oracle_with

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, uses=()):
    """Register a query; ``uses`` names the fixture views the oracle inlines."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle_with(*uses) + oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)
