"""Read queries: dashboard charts over the mart, profiles over landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.functions import Day, day_lit, event_day
from remitlake.schemas import Kind


def selected(
    mart: DataFrame, lo: Day | None, hi: Day | None, codes: Sequence[int] | None
) -> DataFrame:
    """The dashboard filters: day range (inclusive) and currencies; everything by default."""
    if lo is not None:
        mart = mart.filter(F.col("date_update") >= day_lit(lo))
    if hi is not None:
        mart = mart.filter(F.col("date_update") <= day_lit(hi))
    if codes is not None:
        mart = mart.filter(F.col("currency_from").isin(*codes))
    return mart


def dash_volume(mart, lo=None, hi=None, codes=None) -> DataFrame:
    """Transactions per currency over time."""
    return (
        selected(mart, lo, hi, codes)
        .groupBy("date_update", "currency_from")
        .agg(F.sum("cnt_transactions").alias("cnt_transactions"))
    )


def dash_avg(mart, lo=None, hi=None, codes=None) -> DataFrame:
    """Average transactions per account."""
    return selected(mart, lo, hi, codes).select(
        "date_update", "currency_from", "avg_transactions_per_account"
    )


def dash_accounts(mart, lo=None, hi=None, codes=None) -> DataFrame:
    """Unique senders per day and currency. Days must not be added up to a unique total: see
    ``operators.senders`` for spans of days."""
    return selected(mart, lo, hi, codes).select(
        "date_update", "currency_from", "cnt_accounts_make_transactions"
    )


def dash_turnover(mart, lo=None, hi=None, codes=None) -> DataFrame:
    """Turnover per day in the one quote currency."""
    return (
        selected(mart, lo, hi, codes)
        .groupBy("date_update")
        .agg(F.sum("amount_total").cast("decimal(38,2)").alias("amount_total"))
    )


def profile_by_day(landing: DataFrame, kind: Kind) -> DataFrame:
    """Landed messages per payload day, in day order. The day is a partition: no payload is read."""
    return (
        landing.filter(F.col("object_type") == kind.name)
        .groupBy(F.col("event_date").alias("anchor_date"))
        .agg(F.count("*").alias("cnt"))
        .orderBy("anchor_date")
    )


def row_counts(landing: DataFrame) -> DataFrame:
    """Landed rows per message type."""
    return landing.groupBy("object_type").agg(F.count("*").alias("cnt"))


def day_counts(df: DataFrame, day: str) -> DataFrame:
    """Rows per day partition."""
    return df.groupBy(day).agg(F.count("*").alias("cnt"))
