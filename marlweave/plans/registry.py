"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import core_queries, graph_queries

MODULES = [core_queries, graph_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: hybrid recall over four signals."""
    return graph_queries.QUERIES["r03_hybrid_recall"](spark, sf_dir)
