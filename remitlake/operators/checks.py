"""Declared constraints as queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, violations) for every column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns
    ]
    return counts.select(F.inline(F.array(*pairs)))


def fk_violations(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Key values without a dimension row, and how many rows carry each.

    Rows are counted per key before the join, so a dominant key is one row there.
    """
    used = df.groupBy(key).agg(F.count("*").alias("violations"))
    known = dim.select(F.col(dim_key or key).alias(key)).distinct()
    return used.join(known, key, "left_anti")
