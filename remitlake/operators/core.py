"""The core layer: dimensions with hash keys, the fact of finished transactions, rates by day.

``plans.core`` loads it; the daily run does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import event_day, hash_key
from remitlake.operators.convert import real_accounts, with_status


def dimension(df: DataFrame, column: str | Column, name: str, key: str, hasher=hash_key):
    """Distinct non-null values of a column with their surrogate key."""
    value = F.col(column) if isinstance(column, str) else column
    return (
        df.select(value.alias(name))
        .filter(F.col(name).isNotNull())
        .distinct()
        .select(hasher(name).alias(key), name)
    )


def stacked(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Several columns as one, in one pass (sender and receiver are both accounts)."""
    return df.select(F.explode(F.array(*columns)).alias(name))


def dim_accounts(tx: DataFrame, hasher=hash_key) -> DataFrame:
    both = stacked(real_accounts(tx), ["account_number_from", "account_number_to"], "n")
    return dimension(both, "n", "account_number", "hk_account_number", hasher)


def dim_dates(tx: DataFrame, cur: DataFrame, hasher=hash_key) -> DataFrame:
    days = tx.select(event_day("transaction_dt").alias("d")).unionByName(
        cur.select(event_day("date_update").alias("d"))
    )
    return dimension(days, "d", "date", "hk_date", hasher)


def dim_countries(tx: DataFrame, hasher=hash_key) -> DataFrame:
    return dimension(tx, "country", "country", "hk_country", hasher)


def dim_currencies(tx: DataFrame, cur: DataFrame, hasher=hash_key) -> DataFrame:
    codes = tx.select(F.col("currency_code").alias("c")).unionByName(
        stacked(cur, ["currency_code", "currency_code_with"], "c")
    )
    return dimension(codes, "c", "currency_code", "hk_currency", hasher)


def dim_types(tx: DataFrame, hasher=hash_key) -> DataFrame:
    return dimension(tx, "transaction_type", "type", "hk_type", hasher)


def dim_transaction_accounts(tx: DataFrame, hasher=hash_key) -> DataFrame:
    """Accounts with a finished transaction, on either side."""
    done = real_accounts(with_status(tx, ["done"]))
    both = stacked(done, ["account_number_from", "account_number_to"], "n")
    return dimension(both, "n", "id", "hk_id", hasher)


def dimensions(tx: DataFrame, cur: DataFrame, hasher=hash_key) -> dict[str, DataFrame]:
    """Every dimension by its table."""
    return {
        "accounts": dim_accounts(tx, hasher),
        "dates": dim_dates(tx, cur, hasher),
        "countries": dim_countries(tx, hasher),
        "currency_codes": dim_currencies(tx, cur, hasher),
        "transaction_types": dim_types(tx, hasher),
        "transaction_accounts": dim_transaction_accounts(tx, hasher),
    }


def fact_done(tx: DataFrame, hasher=hash_key) -> DataFrame:
    """Finished transactions without test accounts."""
    return real_accounts(with_status(tx, ["done"])).select(
        hasher("operation_id").alias("hk"),
        "operation_id",
        "account_number_from",
        "account_number_to",
        "transaction_dt",
        event_day("transaction_dt").alias("date"),
        "currency_code",
        "country",
        F.col("transaction_type").alias("type"),
        "amount",
    )


def rate_rows(cur: DataFrame, hasher=hash_key) -> DataFrame:
    """Rates keyed by (day, currency, quote currency), with the columns that order them."""
    day = event_day("date_update")
    return cur.select(
        hasher(day, "currency_code", "currency_code_with").alias("hk_rate"),
        day.alias("date"),
        "currency_code",
        "currency_code_with",
        "currency_with_div",
        "date_update",
        "sent_dttm",
        "object_id",
    )
