"""Relational databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame, url: str, table: str, props: Mapping[str, str], connections: int = 16
) -> None:
    """Append. ``connections`` bounds how many tasks insert at the same time."""
    df.write.option("numPartitions", connections).jdbc(
        url=url, table=table, mode="append", properties=dict(props)
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: Mapping[str, str],
    column: str,
    lower: int,
    upper: int,
    partitions: int,
) -> DataFrame:
    """Parallel read, split on an integer column. The bounds only shape the splits, no row is
    left out."""
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=dict(props),
    )
