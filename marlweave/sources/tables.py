"""Readers of the tables, and the deduplication that redelivered rows need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, *key: str) -> DataFrame:
    """One row for each key, however often it was delivered; rows with a null key are dropped.

    Only for columns that stay the same in every delivery: which of the rows is kept isn't defined."""
    return df.where(F.expr(" AND ".join(f"{k} IS NOT NULL" for k in key))).dropDuplicates(list(key))
