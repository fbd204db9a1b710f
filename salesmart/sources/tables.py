"""Parquet table access with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import prefer_compiled


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one driver table; selecting columns here keeps the scan's ReadSchema narrow."""
    return read_target(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", *columns)


def read_target(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Read a column subset of an existing target table."""
    prefer_compiled(spark)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df
