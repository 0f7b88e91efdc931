"""Staging to the metrics mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_lit, day_text
from remitlake.operators.metrics import LOAD_SRC, global_metrics, mart_rows
from remitlake.operators.senders import sender_bitmaps
from remitlake.plans.staging import Lake, stage_day, stage_range
from remitlake.schemas import CURRENCIES, TRANSACTIONS, USD, Kind
from remitlake.sources import generations, tables
from remitlake.sources.landing import compact_landing

# The transaction columns the mart reads; the rest is pruned from the scan.
_TX = ["transaction_dt", "account_number_from", "account_number_to", "currency_code", "amount"]


def day_metrics(
    spark: SparkSession,
    lake: Lake,
    lo: Day,
    hi: Day,
    code: int = USD,
    mode: str = "asof",
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Metrics of the days lo..hi. The transactions are pruned by partition; of the rates only the
    last one per currency and day is read, from the table that staging keeps."""
    tx, cur = _inputs(spark, lake, lo, hi)
    return global_metrics(tx, cur, code, mode, statuses)


def _inputs(spark: SparkSession, lake: Lake, lo: Day, hi: Day) -> tuple[DataFrame, DataFrame]:
    tx = spark.table(lake.table(TRANSACTIONS))
    tx = tx.filter(F.col(tables.EVENT_DAY).between(day_lit(lo), day_lit(hi)))
    cur = spark.table(lake.daily_rates).filter(F.col(tables.EVENT_DAY) <= day_lit(hi))
    cur = cur.filter(F.col(tables.RATE_YEAR) <= F.trunc(day_lit(hi), "year"))
    return tx.select(*_TX, "status"), cur


def keep_senders(spark: SparkSession, lake: Lake, lo: Day, hi: Day, **options) -> list[str]:
    """Rebuild the sender bitmaps of the days lo..hi; returns the days filled."""
    bitmaps = sender_bitmaps(*_inputs(spark, lake, lo, hi), **options)
    return tables.overwrite_days(bitmaps, lake.senders, ["currency_from", "bucket"], days=_days(lo, hi))


def make_mart_day(
    spark: SparkSession,
    lake: Lake,
    day: Day,
    src: str = LOAD_SRC,
    now: dt.datetime | None = None,
    **options,
) -> None:
    """Rebuild one day of the mart; a day without metrics is left empty."""
    rows = mart_rows(day_metrics(spark, lake, day, day, **options), src, now)
    tables.overwrite_day(rows, lake.mart, day)
    keep_senders(spark, lake, day, day, **options)
    _age(spark, lake, day, day)


def _age(spark: SparkSession, lake: Lake, lo: Day, hi: Day) -> None:
    if lake.aged:
        order = [tables.MART_DAY, "currency_from"]
        tables.refresh_aged(spark, lake.mart, f"{lake.mart}_aged", order, days=_days(lo, hi))


def backfill(
    spark: SparkSession,
    lake: Lake,
    lo: Day,
    hi: Day,
    src: str = LOAD_SRC,
    now: dt.datetime | None = None,
    **options,
) -> list[str]:
    """Rebuild the mart for lo..hi in one pass over the staging tables; returns the days filled.

    Readers see the whole range change at once, days that lost their rows too.
    """
    rows = mart_rows(day_metrics(spark, lake, lo, hi, **options), src, now)
    filled = tables.overwrite_days(rows, lake.mart, days=_days(lo, hi))
    keep_senders(spark, lake, lo, hi, **options)
    _age(spark, lake, lo, hi)
    return filled


def _days(lo: Day, hi: Day) -> list[dt.date]:
    first, last = (dt.date.fromisoformat(day_text(d)) for d in (lo, hi))
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def _both_kinds(stage: Callable[[Kind], object]) -> None:
    """Stage both tables at the same time; the smaller one fills idle executors."""
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(stage, (CURRENCIES, TRANSACTIONS)))


def run_day(spark: SparkSession, lake: Lake, run_date: Day, **options) -> str:
    """The whole daily run: tables, both stagings, mart. Works on the day before ``run_date``.

    Landing files of days that the stream is past by then are joined.
    """
    day = dt.date.fromisoformat(day_text(run_date)) - dt.timedelta(days=1)
    tables.ensure_tables(spark, lake.database)
    _both_kinds(lambda kind: stage_day(spark, lake, kind, day))
    make_mart_day(spark, lake, day, **options)
    settle_landing(spark, lake, day, day)
    clean_up(spark, lake)
    return day_text(day)


def clean_up(spark: SparkSession, lake: Lake) -> int:
    """Delete what the tables showed more than ``lake.keep_hours`` ago; returns the writes deleted."""
    age = dt.timedelta(hours=lake.keep_hours)
    return sum(generations.vacuum(spark, name, age) for name in lake.tables(spark))


def settle_landing(spark: SparkSession, lake: Lake, lo: Day, hi: Day) -> int:
    """Join the landing files of the days that came to rest while lo..hi were worked on.

    These are the days ``lake.settled_after`` before; a week more is looked at for late batches and
    runs that were left out. Days in one piece cost a listing.
    """
    first, last = (dt.date.fromisoformat(day_text(d)) for d in (lo, hi))
    rest = dt.timedelta(days=lake.settled_after)
    return compact_landing(spark, lake.landing, first - rest - dt.timedelta(days=7), last - rest)


def run_range(spark: SparkSession, lake: Lake, first_run: Day, last_run: Day, **options):
    """The daily runs ``first_run``..``last_run`` as one job per table instead of one per day."""
    lo, hi = (
        dt.date.fromisoformat(day_text(d)) - dt.timedelta(days=1) for d in (first_run, last_run)
    )
    tables.ensure_tables(spark, lake.database)
    _both_kinds(lambda kind: stage_range(spark, lake, kind, lo, hi))
    filled = backfill(spark, lake, lo, hi, **options)
    settle_landing(spark, lake, lo, hi)
    clean_up(spark, lake)
    return filled
