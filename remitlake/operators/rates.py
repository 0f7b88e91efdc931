"""Exchange rates to one quote currency, as of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitlake.functions import Day, day_lit, event_day, up_to_day
from remitlake.operators.dedup import latest_per_key
from remitlake.schemas import USD

# Newest first; the later two settle equal update times.
RATE_ORDER = ["date_update", "sent_dttm", "object_id"]
RATE_COLUMNS = ["currency_code", "currency_code_with", "currency_with_div", "date_update"]


def to_currency(cur: DataFrame, code: int = USD) -> DataFrame:
    """Rates quoted in one currency."""
    return cur.filter(F.col("currency_code_with") == code)


def latest_rates(cur: DataFrame) -> DataFrame:
    """The newest rate of each currency."""
    return latest_per_key(cur, ["currency_code"], RATE_ORDER).select(
        "currency_code",
        "currency_code_with",
        "currency_with_div",
        event_day("date_update").alias("date_update"),
    )


def rates_as_of(cur: DataFrame, day: Day, code: int = USD) -> DataFrame:
    """The newest rate of each currency no later than the end of ``day``."""
    return latest_rates(to_currency(cur, code).filter(up_to_day("date_update", day)))


def usd_identity(spark: SparkSession, day: Day, code: int = USD) -> DataFrame:
    """The one-row rate of the quote currency to itself."""
    return spark.range(1).select(
        F.lit(code).alias("currency_code"),
        F.lit(code).alias("currency_code_with"),
        F.lit("1.0").cast("decimal(2,1)").alias("currency_with_div"),
        day_lit(day).alias("date_update"),
    )


def with_identity(rates: DataFrame, day: Day, code: int = USD) -> DataFrame:
    """Rates plus the identity row. UNION ALL: a stored rate of the quote currency to itself stays,
    and then counts twice in a join; ``checks.duplicate_keys`` shows such cases."""
    return rates.unionByName(usd_identity(rates.sparkSession, day, code))


def daily_rates(cur: DataFrame, code: int = USD) -> DataFrame:
    """The last rate of each currency on each day that has one: (currency_code, rate_day, rate)."""
    quoted = to_currency(cur, code).withColumn("rate_day", event_day("date_update"))
    return latest_per_key(quoted, ["currency_code", "rate_day"], RATE_ORDER).select(
        "currency_code", "rate_day", "currency_with_div"
    )


def rate_intervals(cur: DataFrame, code: int = USD) -> DataFrame:
    """Validity of each daily rate: [valid_from, valid_to), open-ended for the newest.

    The window holds one currency's days, so its size is set by the calendar, not by the data.
    """
    window = Window.partitionBy("currency_code").orderBy("rate_day")
    return daily_rates(cur, code).select(
        "currency_code",
        F.col("rate_day").alias("valid_from"),
        F.lead("rate_day").over(window).alias("valid_to"),
        "currency_with_div",
    )


def rates_for_days(points: DataFrame, cur: DataFrame, code: int = USD) -> DataFrame:
    """The as-of rate for every row of ``points`` (distinct ``currency_code, day``).

    Both sides are a row per currency and day. They are laid end to end in day order, each point
    taking the last rate before it: one window over calendar-sized groups, and no join. Rates of a
    day come before the point of that day. ``currency_with_div`` is null for a currency without a
    rate so far.
    """
    marks = daily_rates(cur, code).select(
        "currency_code",
        F.col("rate_day").alias("day"),
        F.lit(0).alias("is_point"),
        "currency_with_div",
    )
    asked = points.select(
        "currency_code",
        "day",
        F.lit(1).alias("is_point"),
        F.lit(None).cast("decimal(8,2)").alias("currency_with_div"),
        *[c for c in points.columns if c not in ("currency_code", "day")],
    )
    line = (
        Window.partitionBy("currency_code")
        .orderBy("day", "is_point")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        marks.unionByName(asked, allowMissingColumns=True)
        .withColumn(
            "currency_with_div", F.last("currency_with_div", ignorenulls=True).over(line)
        )
        .filter(F.col("is_point") == 1)
        .drop("is_point")
    )


def lookup_for_days(
    points: DataFrame, cur: DataFrame, code: int = USD, mode: str = "asof"
) -> DataFrame:
    """Rate rows to join on (currency_code, day), identity included.

    ``asof`` takes the newest rate up to the day, ``exact`` only a rate of that very day.
    """
    if mode == "asof":
        found = rates_for_days(points, cur, code).filter(F.col("currency_with_div").isNotNull())
    elif mode == "exact":
        found = daily_rates(cur, code).withColumnRenamed("rate_day", "day")
    else:
        raise ValueError(f"mode must be 'asof' or 'exact', not {mode!r}")
    own = points.filter(F.col("currency_code") == code).withColumn(
        "currency_with_div", F.lit(1).cast("decimal(8,2)")
    )
    columns = ["currency_code", "day", "currency_with_div"]
    return found.select(*columns).unionByName(own.select(*columns))
