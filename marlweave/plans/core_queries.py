"""Queries over the core operators, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import dense_counts, leading
from ..sources.tables import once, table

BLANK = r"^[\s\p{Z}\u0085\u001c-\u001f]*$"


def named_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each node once, with a name that isn't null or blank."""
    return once(table(spark, sf_dir, "entity").select("entity_id", "tenant_id", "name").where(F.col("name").isNotNull() & ~F.col("name").rlike(BLANK)), "entity_id")


def p6_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_counts(named_nodes(spark, sf_dir), ["tenant_id", "name"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leading(p6_counts(spark, sf_dir), "tenant_id", "name").select("tenant_id", "name")


_NAMED = r"SELECT DISTINCT entity_id, tenant_id, name FROM entity WHERE name IS NOT NULL AND tenant_id IS NOT NULL AND NOT regexp_full_match(name, '[\s\pZ]*')"

QUERIES = {"p6_found": p6_found, "p6_counts": p6_counts}
SQL = {
    "p6_counts": f"SELECT tenant_id, name, count(*) AS n FROM ({_NAMED}) GROUP BY ALL",
    "p6_found": f"""SELECT tenant_id, name FROM (SELECT tenant_id, name, row_number() OVER (PARTITION BY tenant_id ORDER BY count(*) DESC, name) AS r
        FROM ({_NAMED}) GROUP BY tenant_id, name) WHERE r = 1""",
}
