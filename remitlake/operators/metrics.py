"""The day-by-currency metrics mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import event_day, hash_key
from remitlake.operators.convert import real_accounts, with_status
from remitlake.operators.rates import daily_rates, rates_for_days
from remitlake.schemas import MART_COLUMNS, USD

LOAD_SRC = "remitlake"


def day_totals(
    tx: DataFrame, statuses: Sequence[str] | None = None, approx_accounts: bool = False
) -> DataFrame:
    """Unconverted totals per (currency_code, day).

    Summing before converting is exact because a rate depends on currency and day alone, and it
    leaves the rate join a row per currency and day. The distinct count shuffles by sender as well,
    so a dominant currency spreads over all tasks.
    """
    accounts = F.approx_count_distinct if approx_accounts else F.count_distinct
    return (
        real_accounts(with_status(tx, statuses))
        .groupBy("currency_code", event_day("transaction_dt").alias("day"))
        .agg(
            F.sum(F.col("amount").cast("decimal(20,0)")).alias("amount_sum"),
            F.count("*").alias("tx_count"),
            accounts("account_number_from").alias("accounts"),
        )
    )


def _rated(totals: DataFrame, cur: DataFrame, code: int, mode: str) -> DataFrame:
    if mode == "asof":
        return rates_for_days(totals, cur, code)
    if mode == "exact":
        same_day = daily_rates(cur, code).withColumnRenamed("rate_day", "day")
        return totals.join(same_day, ["currency_code", "day"], "left")
    raise ValueError(f"mode must be 'asof' or 'exact', not {mode!r}")


def _average(count: Column, accounts: Column) -> Column:
    return (count.cast("decimal(18,0)") / accounts.cast("decimal(18,0)")).cast("decimal(12,4)")


def global_metrics(
    tx: DataFrame,
    cur: DataFrame,
    code: int = USD,
    mode: str = "asof",
    statuses: Sequence[str] | None = None,
    approx_accounts: bool = False,
) -> DataFrame:
    """Turnover, count, average and senders per (day, currency), for all days of ``tx`` at once.

    A currency without a rate is left out. The quote currency always has the rate 1.0, and where
    its own rate is stored too every transaction counts under both, as a plain join would give.
    """
    totals = day_totals(tx, statuses, approx_accounts)
    stored = F.col("currency_with_div")
    own = F.col("currency_code") == code
    matches = stored.isNotNull().cast("bigint") + own.cast("bigint")
    rate = F.coalesce(stored, F.lit(0).cast("decimal(8,2)")) + F.when(own, 1).otherwise(0)
    return (
        _rated(totals, cur, code, mode)
        .withColumn("matches", matches)
        .filter(F.col("matches") > 0)
        .select(
            F.col("day").alias("date_update"),
            F.col("currency_code").alias("currency_from"),
            (F.col("amount_sum") * rate.cast("decimal(10,2)"))
            .cast("decimal(18,2)")
            .alias("amount_total"),
            (F.col("tx_count") * F.col("matches")).alias("cnt_transactions"),
            _average(F.col("tx_count") * F.col("matches"), F.col("accounts")).alias(
                "avg_transactions_per_account"
            ),
            F.col("accounts").alias("cnt_accounts_make_transactions"),
        )
    )


def metrics_of_converted(converted: DataFrame) -> DataFrame:
    """The same measures from transactions already converted row by row."""
    count, accounts = F.count("*"), F.count_distinct("account_number_from")
    return converted.groupBy(
        event_day("transaction_dt").alias("date_update"),
        F.col("currency_code").alias("currency_from"),
    ).agg(
        F.sum("amount_usd").cast("decimal(18,2)").alias("amount_total"),
        count.alias("cnt_transactions"),
        _average(count, accounts).alias("avg_transactions_per_account"),
        accounts.alias("cnt_accounts_make_transactions"),
    )


def with_audit(df: DataFrame, src: str = LOAD_SRC, now: dt.datetime | Column | None = None):
    """Load time and load source."""
    stamp = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    return df.withColumn("load_dt", stamp.cast("timestamp")).withColumn("load_src", F.lit(src))


def mart_rows(
    metrics: DataFrame, src: str = LOAD_SRC, now: dt.datetime | Column | None = None
) -> DataFrame:
    """Metrics as rows of the mart table: surrogate key and audit columns added."""
    keyed = metrics.withColumn("hk_global_metrics", hash_key("date_update", "currency_from"))
    return with_audit(keyed, src, now).select(*MART_COLUMNS)


def only_new(df: DataFrame, target: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key the target does not hold. Unlike NOT IN this can shuffle both sides."""
    return df.join(target, key, "left_anti")
