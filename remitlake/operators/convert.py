"""Row-level conversion to the quote currency.

The mart does not need these: it aggregates first and converts totals (``operators.metrics``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import event_day
from remitlake.operators.rates import lookup_for_days
from remitlake.schemas import USD


def real_accounts(tx: DataFrame) -> DataFrame:
    """Without test accounts: sender and receiver both positive."""
    return tx.filter((F.col("account_number_from") > 0) & (F.col("account_number_to") > 0))


def with_status(tx: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Only the given statuses; all of them by default."""
    return tx if statuses is None else tx.filter(F.col("status").isin(*statuses))


def amount_in_usd(amount: str = "amount", rate: str = "currency_with_div") -> Column:
    """Exact product in minor units of the quote currency."""
    return F.col(amount).cast("decimal(20,0)") * F.col(rate)


def convert(tx: DataFrame, rates: DataFrame) -> DataFrame:
    """Join one day's rates by currency; transactions without a rate drop out.

    No job runs here: adaptive execution broadcasts the rates if they turn out small.
    """
    lookup = rates.select("currency_code", "currency_with_div")
    return tx.join(lookup, "currency_code").withColumn("amount_usd", amount_in_usd())


def rate_points(tx: DataFrame) -> DataFrame:
    """The (currency_code, day) pairs that occur; two columns are read and folded in map tasks."""
    return tx.select("currency_code", event_day("transaction_dt").alias("day")).distinct()


def asof_convert(
    tx: DataFrame,
    cur: DataFrame,
    code: int = USD,
    mode: str = "asof",
    points: DataFrame | None = None,
) -> DataFrame:
    """Convert any span of days in one pass.

    The rate in force is worked out once per (currency, day) that occurs, then found by equality, so
    a transaction meets one lookup row and not a currency's whole rate history. Where ``tx`` is
    costly to compute, give ``points`` (at least the pairs of ``tx``) from a cheaper source.
    """
    points = rate_points(tx) if points is None else points
    lookup = lookup_for_days(points, cur, code, mode)
    dated = tx.withColumn("day", event_day("transaction_dt"))
    return dated.join(lookup, ["currency_code", "day"]).withColumn("amount_usd", amount_in_usd())
