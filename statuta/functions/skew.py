"""Spreading of hot keys over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
_N = "__n_salts"


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int) -> DataFrame:
    """Keys with more rows than one task should take, and over how many tasks to spread them.

    Counting combines before it shuffles, so a key that holds a third of all
    rows costs one row per input partition. Null keys are left out.
    """
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > rows_per_task).select(
        *keys, F.ceil(F.col("__n") / F.lit(rows_per_task)).cast("int").alias(_N)
    )


def salt_many(df: DataFrame, hot: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Rows of the large side get one salt each, from the columns in spread_by (so a retried task salts alike)."""
    n = F.coalesce(F.col(_N), F.lit(1))
    return df.join(hot, keys, "left").withColumn(SALT, F.pmod(F.xxhash64(*spread_by), n.cast("bigint")).cast("int")).drop(_N)


def salt_few(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the small side are repeated for every salt of their key; only hot keys are repeated at all."""
    n = F.coalesce(F.col(_N), F.lit(1))
    return df.join(hot, keys, "left").withColumn(SALT, F.explode(F.sequence(F.lit(0), n - 1))).drop(_N)
