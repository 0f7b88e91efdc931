"""Staging to the core layer: written, judged as written, and only then shown.

A day's load writes its new dimension rows, its facts and its rates beside the tables. Keys that occur
twice, nulls and foreign keys without a dimension row are looked for in what was written; if there are
any, nothing of the load is shown and the day stays as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_lit, day_text, hash_key
from remitlake.operators import checks, core
from remitlake.operators.dedup import latest_per_key
from remitlake.operators.metrics import only_new
from remitlake.operators.rates import RATE_ORDER
from remitlake.plans.staging import Lake
from remitlake.schemas import (
    CURRENCIES,
    DIMENSIONS,
    FACT_DDL,
    FACT_TABLE,
    RATES_DDL,
    RATES_TABLE,
    TRANSACTIONS,
)
from remitlake.sources import generations, tables

T = TypeVar("T")

LOAD_DAY = "load_day"
FACT_DAY = RATE_DAY = "date"
# Column of a fact or rate -> the dimension that must hold its value.
FACT_KEYS = {
    "account_number_from": "accounts",
    "account_number_to": "accounts",
    "date": "dates",
    "currency_code": "currency_codes",
    "country": "countries",
    "type": "transaction_types",
}
RATE_KEYS = {
    "date": "dates",
    "currency_code": "currency_codes",
    "currency_code_with": "currency_codes",
}
# Writes and checks of a load that run at once; each is a few short jobs that leave most cores idle.
_AT_ONCE = 8


class AuditError(ValueError):
    """A load that was not shown, with what was found."""


@dataclass(frozen=True)
class Finding:
    table: str
    check: str
    column: str
    violations: int


def ensure_core(spark: SparkSession, lake: Lake, key_type: str = "bigint") -> None:
    """Create the core tables that are missing; keys made by ``hash_key_md5`` are strings."""
    made = {name: (f"{k} {key_type}, {v} {kind}", LOAD_DAY) for name, (k, v, kind) in DIMENSIONS.items()}
    made[FACT_TABLE] = (FACT_DDL.format(key=key_type), FACT_DAY)
    made[RATES_TABLE] = (RATES_DDL.format(key=key_type), RATE_DAY)
    _at_once(partial(generations.create, spark, lake.core(name), *spec) for name, spec in made.items())


def _at_once(calls: Iterable[Callable[[], T]]) -> list[T]:
    """The results of independent calls, in their order.

    Every call has ended before the error of one is raised, so nothing is written after it.
    """
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        started = [pool.submit(call) for call in calls]
    return [call.result() for call in started]


def _counted(table: str, check: str, column: str, found: DataFrame) -> list[Finding]:
    n = found.count()
    return [Finding(table, check, column, n)] if n else []


def _nulls(table: str, rows: DataFrame, columns: list[str]) -> list[Finding]:
    found = checks.null_violations(rows, columns).filter("violations > 0").collect()
    return [Finding(table, "not null", row.column_name, row.violations) for row in found]


def audit(
    spark: SparkSession, lake: Lake, writes: dict[str, generations.Write], day: Day
) -> list[Finding]:
    """What is wrong with writes that nobody sees yet.

    A dimension is judged with the rows that it has from other days, as readers would see it.
    """
    calls: list[Callable[[], list[Finding]]] = []
    dims: dict[str, DataFrame] = {}
    for name, (key, value, _) in DIMENSIONS.items():
        own = writes[name].read(spark)
        others = spark.table(lake.core(name)).filter(F.col(LOAD_DAY) != day_lit(day))
        dims[name] = others.unionByName(own)
        # Only a key of this load can have become a second one.
        twice = checks.duplicate_keys(dims[name].join(own.select(key).distinct(), key, "left_semi"), [key])
        calls.append(partial(_counted, name, "unique", key, twice))
        calls.append(partial(_nulls, name, own, [key, value]))
    for name, unique, keys in ((FACT_TABLE, "hk", FACT_KEYS), (RATES_TABLE, "hk_rate", RATE_KEYS)):
        rows = writes[name].read(spark)
        calls.append(partial(_counted, name, "unique", unique, checks.duplicate_keys(rows, [unique])))
        calls.append(partial(_nulls, name, rows, [unique, *keys]))
        for column, dim in keys.items():
            held = dims[dim].select(DIMENSIONS[dim][1])
            missing = checks.fk_violations(rows.filter(F.col(column).isNotNull()), held, column, held.columns[0])
            calls.append(partial(_counted, name, "foreign key", column, missing))
    return [found for several in _at_once(calls) for found in several]


def load_core_day(
    spark: SparkSession,
    lake: Lake,
    day: Day,
    hasher: Callable = hash_key,
    fact: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, int]:
    """Load one day of staging into the core layer; returns the rows written per table.

    Dimensions get the values that no other day has brought; facts and rates of the day are replaced, of
    rates the last one per key stays. The same day again gives the same rows. ``fact`` may change the
    facts before they are written. Raises ``AuditError``, and shows nothing, where the audit finds
    something. Dimensions are shown before what points to them.
    """
    on_day = F.col(tables.EVENT_DAY) == day_lit(day)
    tx = spark.table(lake.table(TRANSACTIONS)).filter(on_day)
    cur = spark.table(lake.table(CURRENCIES)).filter(on_day)
    due: dict[str, tuple[DataFrame, dict[str, str]]] = {}
    for name, rows in core.dimensions(tx, cur, hasher).items():
        key = DIMENSIONS[name][0]
        known = spark.table(lake.core(name)).filter(F.col(LOAD_DAY) != day_lit(day))
        due[name] = only_new(rows, known.select(key), key).withColumn(LOAD_DAY, day_lit(day)), {}
    facts = core.fact_done(tx, hasher)
    due[FACT_TABLE] = fact(facts) if fact else facts, {}
    rates = latest_per_key(core.rate_rows(cur, hasher), ["hk_rate"], RATE_ORDER)
    due[RATES_TABLE] = rates, tables.key_filters(rates.columns)
    writes: dict[str, generations.Write] = {}

    def write(name: str) -> None:
        rows, options = due[name]
        writes[name] = generations.write_beside(rows, lake.core(name), options)

    try:
        _at_once(partial(write, name) for name in due)
        found = audit(spark, lake, writes, day)
        if found:
            raise AuditError(f"{day_text(day)} was not loaded: {found}")
    except Exception:
        for done in writes.values():
            generations.forget(spark, done)
        raise
    counts = _at_once(writes[name].read(spark).count for name in due)
    for shown in (DIMENSIONS, (FACT_TABLE, RATES_TABLE)):
        _at_once(partial(generations.show, spark, writes[name], [day]) for name in shown)
    return dict(zip(due, counts))


def upsert_rates(spark: SparkSession, lake: Lake, cur: DataFrame, hasher: Callable = hash_key) -> list[str]:
    """Overwrite stored rates by key with later ones, of any days; returns the days rewritten.

    A key holds its day, so only those days are read.
    """
    rows = core.rate_rows(cur, hasher)
    return tables.upsert_days(rows, lake.core(RATES_TABLE), ["hk_rate"], RATE_ORDER)
