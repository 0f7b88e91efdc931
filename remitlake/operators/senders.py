"""Exact unique senders over any span of days.

Daily counts of unique senders cannot be added up. Bitmaps can: the senders of a day and currency are a
set of bits, a row for each 32,768 account numbers that has any, and a span of days is their union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlake.functions import Day, event_day
from remitlake.operators.convert import real_accounts, with_status
from remitlake.operators.rates import lookup_for_days
from remitlake.operators.reports import selected
from remitlake.schemas import USD


def sender_bitmaps(
    tx: DataFrame,
    cur: DataFrame,
    code: int = USD,
    mode: str = "asof",
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """date_update, currency_from, bucket, senders: who sent what the mart counts.

    Repeats of a sender are folded before the bits are set, in map tasks first, so a sender or currency
    with a third of the rows is a row per task. A (day, currency) without a rate is left out, as in the
    mart.
    """
    day = event_day("transaction_dt").alias("day")
    real = real_accounts(with_status(tx, statuses))
    once = real.select(day, "currency_code", "account_number_from").distinct()
    bits = once.groupBy(
        "day", "currency_code", F.bitmap_bucket_number("account_number_from").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("account_number_from")).alias("senders"))
    points = bits.select("currency_code", "day").distinct()
    rated = lookup_for_days(points, cur, code, mode).select("currency_code", "day")
    return bits.join(rated, ["currency_code", "day"], "left_semi").select(
        F.col("day").alias("date_update"),
        F.col("currency_code").alias("currency_from"),
        "bucket",
        "senders",
    )


def unique_senders(
    bitmaps: DataFrame,
    lo: Day | None = None,
    hi: Day | None = None,
    codes: Sequence[int] | None = None,
) -> DataFrame:
    """currency_from, unique_senders of the days lo..hi; null is all the currencies together."""
    chosen = selected(bitmaps, lo, hi, codes)
    union = F.bitmap_or_agg("senders").alias("senders")
    own = chosen.groupBy("currency_from", "bucket").agg(union)
    every = own.groupBy("bucket").agg(union).withColumn("currency_from", F.lit(None).cast("int"))
    counted = own.unionByName(every).groupBy("currency_from")
    return counted.agg(F.sum(F.bitmap_count("senders")).alias("unique_senders"))


def running_senders(
    bitmaps: DataFrame,
    lo: Day | None = None,
    hi: Day | None = None,
    codes: Sequence[int] | None = None,
) -> DataFrame:
    """date_update, currency_from, unique_senders from lo up to each day.

    Each bucket tells how many senders a day adds to the days before; a day has a row for a currency if
    it has senders of it. Windows hold the days of one bucket, and the days of one currency.
    """
    chosen = selected(bitmaps, lo, hi, codes)
    bucket = Window.partitionBy("currency_from", "bucket").orderBy("date_update")
    so_far = F.bitmap_count(F.bitmap_or_agg("senders").over(bucket))
    counted = chosen.select("date_update", "currency_from", "bucket", so_far.alias("n"))
    added = F.col("n") - F.coalesce(F.lag("n").over(bucket), F.lit(0))
    daily = (
        counted.withColumn("added", added)
        .groupBy("date_update", "currency_from")
        .agg(F.sum("added").alias("added"))
    )
    days = Window.partitionBy("currency_from").orderBy("date_update")
    total = F.sum("added").over(days).alias("unique_senders")
    return daily.select("date_update", "currency_from", total)
