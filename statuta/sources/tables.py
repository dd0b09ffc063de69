"""Reading of the Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table of a data folder. Column pruning and filters reach the scan."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
