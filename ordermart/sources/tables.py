"""Declared source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_source(spark: SparkSession, schema: str, table: str) -> DataFrame:
    """Read a declared table by layer and name."""
    return spark.table(f"{schema}.{table}")
