"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]
) -> DataFrame:
    """Top-1 per key.

    Spark limits each key to its best row in every map task before the shuffle, so a key that holds
    a large share of the rows sends one row per task, not its whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Top-1 per key, largest ``order`` first."""
    return first_per_key(df, keys, [F.col(c).desc() for c in order])


def dedup_batch(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str] = ("sent_dttm",),
    keep: str = "first",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the earliest (``first``) or last (``latest``) row of each key.

    Ties on ``order`` are broken by ``ties``, by default by every other column, so the result does
    not depend on the order in which rows arrive. Narrow ``ties``, such as a position in the topic,
    keep the other columns out of the sort, and those that nobody reads out of the shuffle.
    """
    if keep not in ("first", "latest"):
        raise ValueError(f"keep must be 'first' or 'latest', not {keep!r}")
    named = {k for k in keys if isinstance(k, str)}
    if ties is None:
        ties = [c for c in df.columns if c not in named and c not in order]
    columns = [F.col(c) for c in (*order, *ties)]
    return first_per_key(df, keys, columns if keep == "first" else [c.desc() for c in columns])


def scd1(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Overwrite by key: rows of ``new`` replace rows of ``old``; within a side the latest wins."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return latest_per_key(both, keys, ["__new", *order]).drop("__new")
