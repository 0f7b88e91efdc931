"""Landing to typed staging tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_text, event_day
from remitlake.operators.dedup import dedup_batch
from remitlake.operators.parse import flatten
from remitlake.operators.typing import (
    REASON,
    accepted,
    apply_types,
    rejected,
    split_rejects,
    with_faults,
)
from remitlake.schemas import CURRENCIES, DAILY_RATES, MART_TABLE, SENDERS, Kind
from remitlake.scratch import materialized
from remitlake.sources import tables
from remitlake.sources.landing import position_of, read_landing, read_landing_range, read_undated


@dataclass(frozen=True)
class Lake:
    """Where the data lives: the landing folder and the database of typed tables.

    With ``time_ordered``, every staging load also refreshes a copy laid out by time alone; with
    ``aged``, staging and mart loads refresh copies whose old days are joined to months and years.
    Landing files of a day are joined once the runs are ``settled_after`` days past it. What a table no
    longer shows is kept for ``keep_hours``, for queries that still read it.
    """

    landing: str
    database: str
    time_ordered: bool = False
    aged: bool = False
    settled_after: int = 2
    keep_hours: float = 24

    def tables(self, spark: SparkSession) -> list[str]:
        """Every table of the lake that exists."""
        found = spark.catalog.listTables(self.database)
        return [f"{self.database}.{t.name}" for t in found if t.tableType == "VIEW"]

    def table(self, kind: Kind) -> str:
        return f"{self.database}.{kind.table}"

    def rejects(self, kind: Kind) -> str:
        return f"{self.database}.{kind.table}_rej"

    def by_date(self, kind: Kind) -> str:
        return f"{self.database}.{kind.table}_by_date"

    @property
    def daily_rates(self) -> str:
        return f"{self.database}.{DAILY_RATES}"

    @property
    def mart(self) -> str:
        return f"{self.database}.{MART_TABLE}"

    @property
    def senders(self) -> str:
        return f"{self.database}.{SENDERS}"

    def core(self, name: str) -> str:
        return f"{self.database}.core_{name}"


def _dated(landing: DataFrame, kind: Kind) -> tuple[DataFrame, list[str]]:
    """Flattened text rows with their event day, and the columns that settle equal sending times.

    These are the position in the topic and, for sources without one, a hash of the payload.
    """
    ties = [*position_of(landing), "__payload"]
    hashed = landing.withColumn("__payload", F.xxhash64("payload"))
    flat = flatten(hashed, kind, keep=["object_id", "sent_dttm", *ties])
    return flat.withColumn(tables.EVENT_DAY, event_day(kind.event_time)), ties


def extract(landing: DataFrame, kind: Kind, keep: str = "first") -> DataFrame:
    """Flattened text rows, one per object id and event day."""
    dated, ties = _dated(landing, kind)
    return dedup_batch(dated, ["object_id", tables.EVENT_DAY], keep=keep, ties=ties).drop(*ties)


def staged(landing: DataFrame, kind: Kind, keep: str = "first") -> DataFrame:
    """Typed accepted rows straight from landing, without writing a table.

    Rows are judged before the de-duplication: its shuffle then carries the verdict and the columns
    that are read afterwards, not all that the verdict depends on.
    """
    dated, ties = _dated(landing, kind)
    judged = with_faults(dated.filter(F.col(tables.EVENT_DAY).isNotNull()), kind)
    one = dedup_batch(judged, ["object_id", tables.EVENT_DAY], keep=keep, ties=ties)
    return accepted(one, kind)


def _sides(judged: DataFrame, kind: Kind) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows with their day; a dated extract always has one."""
    return (
        tables.with_day(accepted(judged, kind), kind.event_time),
        tables.with_day(rejected(judged, kind), kind.event_time),
    )


def _refresh(spark: SparkSession, lake: Lake, kind: Kind, days: Sequence[Day]) -> None:
    table = lake.table(kind)
    if kind is CURRENCIES:
        tables.refresh_daily_rates(spark, table, lake.daily_rates, days)
    if lake.time_ordered:
        tables.refresh_by_date(spark, table, lake.by_date(kind), kind.event_time, days)
    if lake.aged:
        order = [kind.event_time, "object_id"]
        tables.refresh_aged(spark, table, f"{table}_aged", order, days=days)


def stage_day(
    spark: SparkSession, lake: Lake, kind: Kind, day: Day, keep: str = "first"
) -> bool:
    """Load one day; False when landing has nothing for it (the stored day then stays)."""
    landing = read_landing(spark, lake.landing, kind.name, day)
    with materialized(
        with_faults(extract(landing, kind, keep), kind), f"{kind.table}-{day_text(day)}"
    ) as judged:
        ok, bad = _sides(judged, kind)
        ordered = ok.sortWithinPartitions(kind.event_time, "object_id")
        if not tables.replace_day(judged, ordered, lake.table(kind), day):
            return False
        tables.overwrite_day(bad, lake.rejects(kind), day)
    _refresh(spark, lake, kind, [day])
    return True


def stage_range(
    spark: SparkSession, lake: Lake, kind: Kind, lo: Day, hi: Day, keep: str = "first"
) -> list[str]:
    """Load every day of lo..hi in one job; returns the days landing has something for.

    Same outcome as ``stage_day`` day by day: days without an extract stay, days whose rows are all
    rejected are cleared. The extract is laid out by day once, in its copy; both tables are written
    from that without a further shuffle.
    """
    landing = read_landing_range(spark, lake.landing, kind.name, lo, hi)
    dealt = with_faults(extract(landing, kind, keep), kind).hint("rebalance", tables.EVENT_DAY)
    with materialized(dealt, kind.table) as judged:
        # One row per calendar day, from one column of the written extract.
        day = F.date_format(tables.EVENT_DAY, "yyyy-MM-dd").alias("day")
        per_day = judged.select(day).distinct().orderBy("day").collect()
        days = [row.day for row in per_day]
        if days:
            ok, bad = _sides(judged, kind)
            order = [kind.event_time, "object_id"]
            tables.overwrite_days(ok, lake.table(kind), order, dealt=True, days=days)
            tables.overwrite_days(bad, lake.rejects(kind), dealt=True, days=days)
    _refresh(spark, lake, kind, days)
    return days


def drop_range(spark: SparkSession, lake: Lake, kind: Kind, lo: Day, hi: Day) -> list[str]:
    """Drop the stored days lo..hi, from the tables that follow this one too; returns the days."""
    days = tables.drop_days(spark, lake.table(kind), lo, hi)
    _refresh(spark, lake, kind, days)
    return days


def undated_rejects(spark: SparkSession, lake: Lake, kind: Kind) -> DataFrame:
    """Landed messages that no day claims, as reject rows."""
    return undated(read_undated(spark, lake.landing, kind.name), kind)


def undated(landing: DataFrame, kind: Kind) -> DataFrame:
    flat = flatten(landing, kind).filter(event_day(kind.event_time).isNull())
    return split_rejects(flat, kind)[1].select(*kind.names, REASON)


def typed(landing: DataFrame, kind: Kind) -> DataFrame:
    """Every landed row with declared types, nothing removed; values that do not fit are null."""
    return apply_types(flatten(landing, kind), kind)
