"""Typed, day-partitioned tables in the catalog."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_lit, day_text, event_day, partition_group
from remitlake.operators.dedup import latest_per_key
from remitlake.operators.metrics import only_new
from remitlake.operators.rates import RATE_ORDER
from remitlake.operators.typing import REASON
from remitlake.schemas import BY_KIND, CURRENCIES, DAILY_RATES, MART_DDL, MART_TABLE, SENDERS, SENDERS_DDL
from remitlake.scratch import materialized
from remitlake.sources import generations

EVENT_DAY = "event_day"
EVENT_MONTH = "event_month"
RATE_YEAR = "rate_year"
PART_GROUP = "part_group"
AGED_AS_OF = "aged_as_of"
MART_DAY = "date_update"
# Columns that rows are looked up by.
KEYED = ("object_id", "hk_rate")
LOOKED_UP = 1000


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def ensure_tables(spark: SparkSession, database: str) -> None:
    """Create the staging, reject and mart tables that are missing."""
    for kind in BY_KIND.values():
        name = f"{database}.{kind.table}"
        generations.create(spark, name, kind.ddl, EVENT_DAY)
        generations.create(spark, f"{name}_rej", f"{kind.text_ddl}, {REASON} string", EVENT_DAY)
    generations.create(spark, f"{database}.{MART_TABLE}", MART_DDL, MART_DAY)
    generations.create(spark, f"{database}.{SENDERS}", SENDERS_DDL, MART_DAY)
    refresh_daily_rates(spark, f"{database}.{CURRENCIES.table}", f"{database}.{DAILY_RATES}", [])


def with_day(df: DataFrame, ts_col: str, name: str = EVENT_DAY) -> DataFrame:
    """Add the day-partition column."""
    return df.withColumn(name, event_day(ts_col))


def overwrite_day(df: DataFrame, table: str, day: Day) -> None:
    """Put ``df`` in place of one day; an empty ``df`` leaves the day empty. Readers see it at once."""
    key = generations.key_of(df.sparkSession, table)
    dated = df.withColumn(key, day_lit(day))
    generations.publish(dated, table, [day], options=key_filters(dated.columns))


def replace_day(extract: DataFrame, accepted: DataFrame, table: str, day: Day) -> bool:
    """Load one day of staging. An empty extract keeps what is there, and returns False.

    What counts is the extract: when it has rows and all of them are rejected, the day is cleared.
    """
    if extract.isEmpty():
        return False
    overwrite_day(accepted, table, day)
    return True


def overwrite_days(
    df: DataFrame,
    table: str,
    sort_cols: Sequence[str] = (),
    dealt: bool = False,
    days: Iterable[Day] = (),
) -> list[str]:
    """Replace every day that occurs in ``df`` and the days ``days``, leaving the others.

    Readers see all days change at once; ``days`` without rows are gone. Returns the days filled. The
    rebalance hint cuts a dominant day into several files; ``sort_cols`` order each of them. ``dealt``
    rows are laid out by day already and are not shuffled again.
    """
    key = generations.key_of(df.sparkSession, table)
    spread = df if dealt else df.hint("rebalance", key)
    ordered = spread.sortWithinPartitions(key, *sort_cols)
    return generations.publish(ordered, table, days, options=key_filters(df.columns))


def key_filters(columns: Sequence[str]) -> dict[str, str]:
    """Writer options for a Bloom filter on each key column, per row group.

    Keys are random text, so neither ranges nor dictionaries tell where one is. One in a million
    look-ups in a row group is in vain, so that thousands of keys can be looked up at once.
    """
    options = {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": "8388608"}
    for column in (c for c in KEYED if c in columns):
        options |= {
            f"parquet.bloom.filter.enabled#{column}": "true",
            f"parquet.bloom.filter.fpp#{column}": "0.000001",
            f"parquet.enable.dictionary#{column}": "false",
        }
    return options


def any_of(column: str, values: Sequence) -> Column:
    """The column equals one of the values, as comparisons that Parquet looks up one by one.

    A list of values would be pushed to the scan as a range only. The tree is balanced, as deep as the
    logarithm of their number.
    """
    tests = [F.col(column) == F.lit(v) for v in values]
    while len(tests) > 1:
        pairs = [tests[i : i + 2] for i in range(0, len(tests), 2)]
        tests = [p[0] | p[1] if len(p) == 2 else p[0] for p in pairs]
    return tests[0] if tests else F.lit(False)


def holding(rows: DataFrame, keys: Sequence[str], new: DataFrame) -> DataFrame:
    """The rows that may hold a key of ``new``, so far as the files can tell.

    Up to LOOKED_UP keys are looked up in the Bloom filters of each row group; with more, a row group
    without any of them is rare and nothing is left out.
    """
    if len(keys) != 1 or keys[0] not in KEYED:
        return rows
    asked = new.select(*keys).distinct().limit(LOOKED_UP + 1).collect()
    return rows if len(asked) > LOOKED_UP else rows.filter(any_of(keys[0], [r[0] for r in asked]))


def stored_days(spark: SparkSession, table: str) -> list[str]:
    """Days a table has partitions for, from the catalog."""
    return generations.days_of(spark, table)


def drop_days(spark: SparkSession, table: str, lo: Day, hi: Day) -> list[str]:
    """Drop the day partitions lo..hi, inclusive; returns the days dropped."""
    first, last = day_text(lo), day_text(hi)
    days = [d for d in stored_days(spark, table) if first <= d <= last]
    return generations.discard(spark, table, days)


def drop_listed_days(spark: SparkSession, table: str, days: Sequence[Day]) -> list[str]:
    """Drop the given day partitions where they exist; returns the days dropped."""
    return generations.discard(spark, table, days)


def append_new(df: DataFrame, table: str, key: str) -> None:
    """Append the rows whose key the table does not hold yet, as files of their own."""
    target = df.sparkSession.table(table)
    fresh = only_new(df, target.select(key), key)
    day = generations.key_of(df.sparkSession, table)
    generations.publish(fresh.sortWithinPartitions(day), table, append=True)


def write_clustered(
    df: DataFrame, table: str, hash_cols: Sequence[str], sort_cols: Sequence[str], n: int
) -> None:
    """A copy in ``n`` segments by hash, each file sorted, which the planner knows about.

    Copies with the same segments are joined, and rows with the same ``hash_cols`` are grouped, without
    a shuffle. Rebalancing cuts a segment that one key value makes too large into several files.
    """
    spread = df.hint("rebalance", n, *hash_cols)
    writer = spread.write.mode("overwrite").format("parquet")
    writer.bucketBy(n, *hash_cols).sortBy(*sort_cols).saveAsTable(table)


def write_by_date(df: DataFrame, table: str, date_col: str, n: int) -> None:
    """A copy laid out by time alone, for time-range reads.

    Ranges of (time, hash of the row id) give files of one time span each, and a moment that holds
    very many rows (rates are all stamped midnight) still spreads over several files.
    """
    spread = df.repartitionByRange(n, date_col, F.xxhash64("object_id"))
    spread.sortWithinPartitions(date_col).write.mode("overwrite").format("parquet").saveAsTable(
        table
    )


def refresh_by_date(
    spark: SparkSession, source: str, table: str, date_col: str, days: Sequence[Day]
) -> None:
    """Bring a time-ordered copy of ``source`` up to date for the months that hold ``days``.

    Only those months are read and replaced, each as ranges of (time, hash of the row id), so a file
    covers one stretch of time. A month without rows is dropped. The copy is created when missing.
    """
    months = sorted({dt.date.fromisoformat(day_text(d)).replace(day=1) for d in days})
    if not months:
        return
    columns = ", ".join(f"{name} {kind}" for name, kind in spark.table(source).dtypes)
    generations.create(spark, table, columns, EVENT_MONTH)
    rows = spark.table(source).withColumn(EVENT_MONTH, F.trunc(EVENT_DAY, "month"))
    rows = rows.filter(F.col(EVENT_MONTH).isin(months))
    ranges = rows.repartitionByRange(EVENT_MONTH, date_col, F.xxhash64("object_id"))
    overwrite_days(ranges, table, [date_col], dealt=True, days=months)


def refresh_daily_rates(spark: SparkSession, source: str, table: str, days: Sequence[Day]) -> None:
    """Bring the last rate per currency pair and day up to date for ``days`` (loaded or cleared).

    The mart reads this table and not the history of all rates. It holds a few rows a day, a partition
    per year; the years that hold ``days`` are rewritten, from the source for those days and from
    themselves for the others. A table without rows is filled for all days that the source stores.
    """
    generations.create(spark, table, f"{CURRENCIES.ddl}, {EVENT_DAY} date", RATE_YEAR)
    if not stored_days(spark, table):
        days = stored_days(spark, source)
    due = sorted({dt.date.fromisoformat(day_text(d)) for d in days})
    if not due:
        return
    years = sorted({d.replace(month=1, day=1) for d in due})
    fresh = spark.table(source).filter(F.col(EVENT_DAY).isin(due))
    last = latest_per_key(fresh, ["currency_code", "currency_code_with", EVENT_DAY], RATE_ORDER)
    others = spark.table(table).filter(F.col(RATE_YEAR).isin(years) & ~F.col(EVENT_DAY).isin(due))
    rows = last.withColumn(RATE_YEAR, F.trunc(EVENT_DAY, "year")).unionByName(others)
    overwrite_days(rows, table, [EVENT_DAY, "currency_code"], days=years)


def upsert_days(df: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """Overwrite by key in a day-partitioned table; returns the days rewritten.

    All stored rows of a key give way to its last new row; other rows stay as they are. Rewritten are the
    days of the new rows and those that hold one of the keys, found from the key columns alone and, for
    few keys, from the row groups whose Bloom filter knows one; the other days are not touched. A row whose day changes moves, and a day
    that is left without rows is dropped. Stored rows of a null key stay. The driver sees a row per day.
    """
    spark = df.sparkSession
    day = generations.key_of(spark, table)
    old = spark.table(table)
    new = latest_per_key(df.select(*old.columns), keys, order)
    with materialized(new, "upsert-new") as new:
        held = holding(old.select(day, *keys), keys, new).join(new.select(*keys), list(keys), "left_semi").select(day)
        days = [row[0] for row in held.union(new.select(day)).distinct().collect()]
        if not days:
            return []
        stays = only_new(old.filter(F.col(day).isin(days)), new.select(*keys), list(keys))
        overwrite_days(stays.select(*old.columns).unionByName(new), table, days=days)
    return sorted(map(str, days))


def compact_days(
    df: DataFrame,
    table: str,
    event_time: str,
    as_of: Day,
    n: int,
    months: int = 3,
    years: int = 2,
) -> None:
    """A copy in which older day partitions are joined into months and years.

    Written as ``n`` ranges of (group, time), so a file covers one stretch of time and day reads
    skip the others.
    """
    rows = df.withColumn("part_group", partition_group(EVENT_DAY, as_of, months, years))
    spread = rows.repartitionByRange(n, "part_group", event_time, F.xxhash64("object_id"))
    spread.sortWithinPartitions("part_group", event_time).write.mode("overwrite").partitionBy(
        "part_group"
    ).format("parquet").saveAsTable(table)


def refresh_aged(
    spark: SparkSession,
    source: str,
    table: str,
    sort_cols: Sequence[str],
    as_of: Day | None = None,
    days: Sequence[Day] = (),
    months: int = 3,
    years: int = 2,
) -> list[str]:
    """Bring the aged copy of a day-partitioned table up to date; returns the groups rewritten.

    Rewritten are the groups that ``days`` (those just loaded or cleared) belong to, groups not
    stored yet, and those that stored days or months have grown into since the last refresh; the
    parts they replace are dropped after the write. ``as_of`` defaults to the newest day stored and
    never goes back: the table keeps the latest one. The driver sees a row per calendar day.
    """
    key = generations.key_of(spark, source)
    columns = ", ".join(f"{name} {kind}" for name, kind in spark.table(source).dtypes)
    generations.create(spark, table, columns, PART_GROUP)
    own, stored = set(stored_days(spark, source)), set(stored_days(spark, table))
    known = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    seen = [day_text(as_of)] if as_of else sorted(own)[-1:]
    now = max([*seen, known.get(AGED_AS_OF, "")], default="")
    if not now:
        return []
    spark.sql(f"ALTER VIEW {table} SET TBLPROPERTIES ('{AGED_AS_OF}' = '{now}')")
    touched = {day_text(d) for d in days}
    dates = [(dt.date.fromisoformat(d),) for d in sorted(own | stored | touched)]
    grouped = spark.createDataFrame(dates, "day date").select(
        "day", partition_group("day", now, months, years).alias("g")
    )
    group_of = {str(r.day): str(r.g) for r in grouped.collect()}
    live = {group_of[d] for d in own}
    due = (live - stored) | {group_of[d] for d in (stored - live) | touched}
    if not due:
        return []
    inside = [dt.date.fromisoformat(d) for d in sorted(own) if group_of[d] in due]
    rows = spark.table(source).filter(F.col(key).isin(inside) if inside else F.lit(False))
    rows = rows.withColumn(PART_GROUP, partition_group(key, now, months, years))
    ranges = rows.repartitionByRange(PART_GROUP, *sort_cols)
    return overwrite_days(ranges, table, sort_cols, dealt=True, days=(stored - live) | due)


def run_sql(spark: SparkSession, text: str, day: Day, **frames: DataFrame) -> DataFrame:
    """Run SQL with the anchor day bound to ``:day`` and DataFrames to ``{name}``."""
    return spark.sql(text, args={"day": dt.date.fromisoformat(day_text(day))}, **frames)
