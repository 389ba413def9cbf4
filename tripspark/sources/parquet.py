"""Parquet reads: schema comes from the file footers; scans are columnar and
receive pushed filters and pruned columns from Catalyst."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, e.g. ``read_table(spark, dir, "orders")``."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")
