"""Every operator as a query over the given tables: ``f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import event_day, on_day, partition_group
from remitlake.functions import hash_key_md5 as md5_key
from remitlake.operators import checks, convert, core, metrics, parse, rates, reports, senders
from remitlake.operators.dedup import dedup_batch, latest_per_key, scd1
from remitlake.operators.typing import split_rejects
from remitlake.plans import calendar, mart, staging
from remitlake.plans import core as core_plan
from remitlake.schemas import (
    BY_KIND,
    CURRENCIES,
    FACT_TABLE,
    MART_COLUMNS,
    RATES_TABLE,
    TRANSACTIONS,
    Kind,
)
from remitlake.scratch import scratch_path
from remitlake.sources import csv_files, event_feed, landing, tables, topics
from remitlake.streaming import landing as stream

DAY = "2024-01-15"
NEXT_DAY = "2024-01-16"
DROP = ("2024-01-05", "2024-01-10")
COMPACT_AS_OF = "2024-04-10"
GROUPS_AS_OF = "1998-06-15"
LOAD_TIME = dt.datetime(2024, 2, 1)
MART_MEASURES = [c for c in MART_COLUMNS if c not in ("hk_global_metrics", "load_dt", "load_src")]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name, with zone-less timestamps in the result."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_times(fn(spark, sf_dir))

    _QUERIES[fn.__name__] = run
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the given tables store them."""
    zoned = [n for n, t in df.dtypes if t == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df


# --- inputs -----------------------------------------------------------------------------------


def _events(spark, sf_dir):
    return event_feed.events(spark, sf_dir)


def _landed(spark, sf_dir, dirty=False, kind=None):
    return event_feed.landed(_events(spark, sf_dir), dirty, kind)


def _raw(spark, sf_dir, kind: Kind) -> DataFrame:
    """Typed rows of one kind, repeats included."""
    return event_feed.typed_rows(_events(spark, sf_dir), kind)


def _staged(spark, sf_dir, kind: Kind, keep="first") -> DataFrame:
    """Typed rows, one per object id and event day."""
    rows = event_feed.typed_rows(_events(spark, sf_dir), kind, position=True)
    dated, ties = tables.with_day(rows, kind.event_time), landing.position_of(rows)
    return dedup_batch(dated, ["object_id", tables.EVENT_DAY], keep=keep, ties=ties).drop(*ties)


def _tx(spark, sf_dir, keep="first"):
    return _staged(spark, sf_dir, TRANSACTIONS, keep).drop(tables.EVENT_DAY)


def _cur(spark, sf_dir, keep="first"):
    return _staged(spark, sf_dir, CURRENCIES, keep).drop(tables.EVENT_DAY)


def _mart(spark, sf_dir):
    return metrics.global_metrics(_tx(spark, sf_dir), _cur(spark, sf_dir))


def _lake(spark) -> staging.Lake:
    """A new database and landing folder in the shared scratch folder."""
    database = f"remitlake_{uuid.uuid4().hex}"
    tables.ensure_database(spark, database, scratch_path(spark, "db"))
    tables.ensure_tables(spark, database)
    return staging.Lake(scratch_path(spark, "landing"), database)


def _bounds(spark, sf_dir) -> tuple[dt.date, dt.date]:
    row = event_feed.day_bounds(_events(spark, sf_dir)).first()
    return row.lo, row.hi


def _loaded(spark, sf_dir, *kinds: Kind) -> staging.Lake:
    """A lake with the events landed and the given kinds staged for all days."""
    lake = _lake(spark)
    landing.land(_landed(spark, sf_dir), lake.landing)
    lo, hi = _bounds(spark, sf_dir)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda kind: staging.stage_range(spark, lake, kind, lo, hi), kinds))
    return lake


# --- sources, sinks, layout -------------------------------------------------------------------


def _readable(messages: DataFrame) -> DataFrame:
    return parse.parse_envelope(messages, keep=["topic", "partition", "offset"]).drop("payload")


@query
def peek_messages(spark, sf_dir):
    return _readable(topics.first_messages(event_feed.messages(_events(spark, sf_dir)), 701))


@query
def peek_per_topic(spark, sf_dir):
    messages = event_feed.messages(_events(spark, sf_dir))
    return _readable(topics.first_messages_per_topic(messages, 8))


@query
def land_counts(spark, sf_dir):
    path = scratch_path(spark, "landing")
    landing.land(_landed(spark, sf_dir), path)
    return reports.row_counts(landing.read_all(spark, path))


@query
def landing_day_scan(spark, sf_dir):
    path = scratch_path(spark, "landing")
    landing.land(_landed(spark, sf_dir), path)
    return landing.read_landing(spark, path, TRANSACTIONS.name, DAY).select(
        "object_id", "object_type", "sent_dttm", "event_date"
    )


def _dirty_extract(spark, sf_dir, kind):
    rows = staging.extract(_landed(spark, sf_dir, dirty=True, kind=kind), kind)
    return rows.filter(F.col(tables.EVENT_DAY).isNotNull()).drop(tables.EVENT_DAY)


@query
def rejects_ok(spark, sf_dir):
    return split_rejects(_dirty_extract(spark, sf_dir, TRANSACTIONS), TRANSACTIONS)[0]


@query
def rejects_bad(spark, sf_dir):
    return split_rejects(_dirty_extract(spark, sf_dir, TRANSACTIONS), TRANSACTIONS)[1]


@query
def rejects_ok_currencies(spark, sf_dir):
    return split_rejects(_dirty_extract(spark, sf_dir, CURRENCIES), CURRENCIES)[0]


@query
def rejects_bad_currencies(spark, sf_dir):
    return split_rejects(_dirty_extract(spark, sf_dir, CURRENCIES), CURRENCIES)[1]


@query
def rejects_undated(spark, sf_dir):
    landed = _landed(spark, sf_dir, dirty=True, kind=TRANSACTIONS)
    return staging.undated(landed, TRANSACTIONS)


@query
def csv_round_trip(spark, sf_dir):
    rows = _dirty_extract(spark, sf_dir, TRANSACTIONS).withColumn(
        "sent_dttm", F.col("sent_dttm").cast("string")
    )
    path = csv_files.export_csv(rows, scratch_path(spark, "csv"), TRANSACTIONS.table, DAY)
    loaded = csv_files.load_csv(spark, path, TRANSACTIONS.text_ddl)
    return split_rejects(csv_files.split_corrupt(loaded)[0], TRANSACTIONS)[0]


@query
def csv_line_breaks(spark, sf_dir):
    """Text with line ends, quotes and backslashes; a line of the file is still a row."""
    odd = F.concat("status", F.lit('\n"\\n,\r\\'), "country", F.lit("\\\\\n"))
    rows = _tx(spark, sf_dir).select("object_id", "account_number_from", odd.alias("note"))
    path = csv_files.export_csv(rows, scratch_path(spark, "csv"), "notes", DAY)
    ddl = "object_id string, account_number_from bigint, note string"
    return csv_files.split_corrupt(csv_files.load_csv(spark, path, ddl))[0]


@query
def stage_replace_day(spark, sf_dir):
    lake = _loaded(spark, sf_dir, TRANSACTIONS)
    staging.stage_day(spark, lake, TRANSACTIONS, DAY, keep="latest")
    return spark.table(lake.table(TRANSACTIONS))


@query
def mart_replace_day(spark, sf_dir):
    lake = _loaded(spark, sf_dir, CURRENCIES, TRANSACTIONS)
    mart.backfill(spark, lake, *_bounds(spark, sf_dir))
    mart.make_mart_day(spark, lake, DAY, statuses=["done"])
    return spark.table(lake.mart).select(*MART_MEASURES)


@query
def drop_days_remaining(spark, sf_dir):
    lake = _loaded(spark, sf_dir, CURRENCIES)
    staging.drop_range(spark, lake, CURRENCIES, *DROP)
    return reports.day_counts(spark.table(lake.table(CURRENCIES)), tables.EVENT_DAY)


@query
def mart_append_new(spark, sf_dir):
    lake = _loaded(spark, sf_dir, CURRENCIES, TRANSACTIONS)
    mart.make_mart_day(spark, lake, DAY, statuses=["done"])
    rows = metrics.mart_rows(mart.day_metrics(spark, lake, *_bounds(spark, sf_dir)))
    tables.append_new(rows, lake.mart, "hk_global_metrics")
    return spark.table(lake.mart).select(*MART_MEASURES)


@query
def day_partition_counts(spark, sf_dir):
    lake = _loaded(spark, sf_dir, TRANSACTIONS)
    return reports.day_counts(spark.table(lake.table(TRANSACTIONS)), tables.EVENT_DAY)


@query
def partition_groups(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return (
        orders.groupBy(event_day("o_orderdate").alias("day"))
        .agg(F.count("*").alias("cnt"))
        .withColumn("part_group", partition_group("day", GROUPS_AS_OF))
    )


def _slices(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query
def compacted_days(spark, sf_dir):
    rows = _staged(spark, sf_dir, TRANSACTIONS)
    table = f"{_lake(spark).database}.compacted"
    tables.compact_days(rows, table, TRANSACTIONS.event_time, COMPACT_AS_OF, _slices(spark))
    return spark.table(table).groupBy("part_group", tables.EVENT_DAY).agg(
        F.count("*").alias("cnt"), F.sum("amount").alias("amount")
    )


@query
def aged_refresh(spark, sf_dir):
    """The aged copy as the jobs keep it: days first, and groups once a later day makes them old."""
    lake = _loaded(spark, sf_dir, TRANSACTIONS)
    source = lake.table(TRANSACTIONS)
    copy, order = f"{source}_aged", [TRANSACTIONS.event_time, "object_id"]
    tables.refresh_aged(spark, source, copy, order)
    tables.refresh_aged(spark, source, copy, order, as_of=COMPACT_AS_OF)
    return spark.table(copy).groupBy(tables.PART_GROUP, tables.EVENT_DAY).agg(
        F.count("*").alias("cnt"), F.sum("amount").alias("amount")
    )


@query
def by_date_refresh(spark, sf_dir):
    """The time-ordered copy as the jobs keep it, after one day was dropped from the table."""
    lake = _loaded(spark, sf_dir, CURRENCIES)
    source, copy = lake.table(CURRENCIES), lake.by_date(CURRENCIES)
    tables.refresh_by_date(spark, source, copy, CURRENCIES.event_time, tables.stored_days(spark, source))
    tables.drop_days(spark, source, DAY, DAY)
    tables.refresh_by_date(spark, source, copy, CURRENCIES.event_time, [DAY])
    return spark.table(copy).drop(tables.EVENT_MONTH)


@query
def clustered_join(spark, sf_dir):
    """First and last arrivals side by side, from copies in segments by message id: no shuffle."""
    database, key = _lake(spark).database, "object_id"
    copies = {}
    for keep in ("first", "latest"):
        copies[keep] = f"{database}.by_id_{keep}"
        rows = _staged(spark, sf_dir, TRANSACTIONS, keep)
        tables.write_clustered(rows, copies[keep], [key], [key], _slices(spark))
    first, last = (spark.table(t).select(key, tables.EVENT_DAY, "status") for t in copies.values())
    last = last.withColumnRenamed("status", "last_status")
    return first.join(last, [key, tables.EVENT_DAY])


@query
def clustered_copy(spark, sf_dir):
    table = f"{_lake(spark).database}.clustered"
    columns = ["transaction_dt", "object_id"]
    tables.write_clustered(_tx(spark, sf_dir), table, columns, columns, _slices(spark))
    return spark.table(table)


@query
def by_date_copy(spark, sf_dir):
    table = f"{_lake(spark).database}.currencies_by_date"
    tables.write_by_date(_cur(spark, sf_dir), table, "date_update", _slices(spark))
    return spark.table(table)


@query
def by_date_copy_transactions(spark, sf_dir):
    table = f"{_lake(spark).database}.transactions_by_date"
    tables.write_by_date(_tx(spark, sf_dir), table, "transaction_dt", _slices(spark))
    return spark.table(table)


# --- projections, filters ---------------------------------------------------------------------


def _envelopes(spark, sf_dir):
    return parse.parse_envelope(event_feed.messages(_events(spark, sf_dir)), keep=["offset"])


@query
def parse_envelope(spark, sf_dir):
    return _envelopes(spark, sf_dir).select(
        "offset",
        "object_id",
        "object_type",
        "sent_dttm",
        F.get_json_object("payload", "$.currency_code").alias("currency_code"),
    )


@query
def route_currency(spark, sf_dir):
    return parse.route(_envelopes(spark, sf_dir))[CURRENCIES.name].drop("payload")


@query
def route_transaction(spark, sf_dir):
    return parse.route(_envelopes(spark, sf_dir))[TRANSACTIONS.name].drop("payload")


@query
def flatten_currencies(spark, sf_dir):
    return parse.flatten_currencies(_landed(spark, sf_dir, kind=CURRENCIES))


@query
def flatten_transactions(spark, sf_dir):
    return parse.flatten_transactions(_landed(spark, sf_dir, kind=TRANSACTIONS))


@query
def typed_currencies(spark, sf_dir):
    return staging.typed(_landed(spark, sf_dir, dirty=True, kind=CURRENCIES), CURRENCIES)


@query
def typed_transactions(spark, sf_dir):
    return staging.typed(_landed(spark, sf_dir, dirty=True, kind=TRANSACTIONS), TRANSACTIONS)


@query
def filter_day(spark, sf_dir):
    return _raw(spark, sf_dir, TRANSACTIONS).filter(on_day("transaction_dt", DAY))


@query
def rates_to_usd(spark, sf_dir):
    return rates.to_currency(_cur(spark, sf_dir))


@query
def rates_as_of_day(spark, sf_dir):
    return rates.rates_as_of(_cur(spark, sf_dir), DAY)


@query
def rates_with_identity(spark, sf_dir):
    return rates.with_identity(rates.rates_as_of(_cur(spark, sf_dir), DAY), DAY)


@query
def real_accounts(spark, sf_dir):
    return convert.real_accounts(_tx(spark, sf_dir))


@query
def status_done_metrics(spark, sf_dir):
    return metrics.global_metrics(_tx(spark, sf_dir), _cur(spark, sf_dir), statuses=["done"])


@query
def mart_audit(spark, sf_dir):
    return metrics.with_audit(_mart(spark, sf_dir), "daily run", LOAD_TIME).select(
        "date_update", "currency_from", "load_dt", "load_src"
    )


PARAM_SQL = """
SELECT status, transaction_type, COUNT(*) AS cnt, SUM(amount) AS amount
FROM {tx} WHERE CAST(transaction_dt AS DATE) = :day
GROUP BY status, transaction_type
"""


@query
def param_sql(spark, sf_dir):
    return tables.run_sql(spark, PARAM_SQL, DAY, tx=_tx(spark, sf_dir))


# --- joins ------------------------------------------------------------------------------------


def _converted(spark, sf_dir):
    cur = _cur(spark, sf_dir)
    day_rates = rates.with_identity(rates.rates_as_of(cur, DAY), DAY)
    tx = convert.real_accounts(_tx(spark, sf_dir).filter(on_day("transaction_dt", DAY)))
    return convert.convert(tx, day_rates)


@query
def join_rates(spark, sf_dir):
    return _converted(spark, sf_dir).select("object_id", "currency_code", "currency_with_div")


@query
def amount_usd(spark, sf_dir):
    return _converted(spark, sf_dir).select("object_id", "amount", "amount_usd")


def _across_days(spark, sf_dir, mode):
    tx = convert.real_accounts(_tx(spark, sf_dir))
    points = convert.rate_points(_raw(spark, sf_dir, TRANSACTIONS))
    return convert.asof_convert(tx, _cur(spark, sf_dir), mode=mode, points=points).select(
        "object_id", "day", "currency_code", "currency_with_div", "amount_usd"
    )


@query
def asof_convert(spark, sf_dir):
    return _across_days(spark, sf_dir, "asof")


@query
def exact_day_convert(spark, sf_dir):
    return _across_days(spark, sf_dir, "exact")


@query
def exact_day_metrics(spark, sf_dir):
    return metrics.global_metrics(_tx(spark, sf_dir), _cur(spark, sf_dir), mode="exact")


@query
def rate_intervals(spark, sf_dir):
    return rates.rate_intervals(_cur(spark, sf_dir))


@query
def only_new(spark, sf_dir):
    """Mart rows of all days that a mart holding the finished transactions of one day lacks."""
    tx, cur = _tx(spark, sf_dir), _cur(spark, sf_dir)
    held = metrics.global_metrics(
        tx.filter(on_day("transaction_dt", DAY)), cur, statuses=["done"]
    )
    rows = metrics.mart_rows(metrics.global_metrics(tx, cur))
    return metrics.only_new(rows, metrics.mart_rows(held), "hk_global_metrics").select(
        *MART_MEASURES
    )


# --- aggregates -------------------------------------------------------------------------------


def _pipeline(spark, sf_dir):
    """Staged kinds from messages: parse, flatten, de-duplicate, type, reject."""
    return {k: staging.staged(_landed(spark, sf_dir, kind=k), k) for k in BY_KIND.values()}


@query
def global_metrics_day(spark, sf_dir):
    """From raw messages to one day of the mart."""
    landed = _landed(spark, sf_dir, kind=TRANSACTIONS)
    day_tx = landed.filter(F.col("event_date") == F.lit(DAY).cast("date"))
    tx = staging.staged(day_tx, TRANSACTIONS)
    cur = staging.staged(_landed(spark, sf_dir, kind=CURRENCIES), CURRENCIES)
    return metrics.global_metrics(tx, cur).withColumn(
        "hk_md5", md5_key("date_update", "currency_from")
    )


@query
def global_metrics_month(spark, sf_dir):
    """From raw messages to every day of the mart in one pass."""
    staged = _pipeline(spark, sf_dir)
    return metrics.global_metrics(staged[TRANSACTIONS], staged[CURRENCIES])


def _measure(spark, sf_dir, name):
    return _mart(spark, sf_dir).select("date_update", "currency_from", name)


@query
def amount_total(spark, sf_dir):
    return _measure(spark, sf_dir, "amount_total")


@query
def cnt_transactions(spark, sf_dir):
    return _measure(spark, sf_dir, "cnt_transactions")


@query
def cnt_accounts(spark, sf_dir):
    return _measure(spark, sf_dir, "cnt_accounts_make_transactions")


@query
def avg_per_account(spark, sf_dir):
    return _measure(spark, sf_dir, "avg_transactions_per_account")


@query
def distinct_rates(spark, sf_dir):
    return (
        rates.to_currency(_cur(spark, sf_dir))
        .select("currency_code", "currency_code_with", "currency_with_div")
        .distinct()
    )


@query
def profile_by_day(spark, sf_dir):
    return reports.profile_by_day(
        _landed(spark, sf_dir, dirty=True, kind=TRANSACTIONS), TRANSACTIONS
    )


# --- one row per key --------------------------------------------------------------------------


@query
def latest_rate_first_value(spark, sf_dir):
    cur = rates.to_currency(_cur(spark, sf_dir))
    return latest_per_key(cur, ["currency_code"], rates.RATE_ORDER)


@query
def dedup_currencies(spark, sf_dir):
    landed = _landed(spark, sf_dir, kind=CURRENCIES)
    return staging.extract(landed, CURRENCIES)


@query
def dedup_transactions(spark, sf_dir):
    landed = _landed(spark, sf_dir, kind=TRANSACTIONS)
    return staging.extract(landed, TRANSACTIONS)


@query
def dedup_latest(spark, sf_dir):
    return _staged(spark, sf_dir, TRANSACTIONS, keep="latest")


# --- functions --------------------------------------------------------------------------------


@query
def hash_key_md5(spark, sf_dir):
    return _raw(spark, sf_dir, TRANSACTIONS).select(
        "object_id", md5_key(event_day("transaction_dt"), "currency_code").alias("hk")
    )


@query
def anchor_dates(spark, sf_dir):
    return calendar.run_calendar(event_feed.day_bounds(_events(spark, sf_dir)))


# --- streaming --------------------------------------------------------------------------------


def _landed_by_stream(spark, sf_dir, mode) -> DataFrame:
    path, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    messages = event_feed.messages(event_feed.events_stream(spark, sf_dir), dirty=True)
    stream.run_landing(
        messages, path, checkpoint, mode=mode, available_now=True
    ).awaitTermination()
    return landing.read_all(spark, path)


@query
def stream_dedup_exact(spark, sf_dir):
    return _landed_by_stream(spark, sf_dir, "exact").select("object_type", "object_id")


@query
def stream_dedup_bounded(spark, sf_dir):
    return _landed_by_stream(spark, sf_dir, "bounded").select("object_type", "object_id")


#: Rows in a file of a slice at most: what is parsed at once is then cut by rows, not by row groups.
SLICE_FILE_ROWS = 100_000


def _arrivals(spark, sf_dir) -> list[DataFrame]:
    """The events in three parts that arrive one after the other, a third of the days each.

    Every fiftieth event of the first part comes with the last one, many days late.
    """
    rows, lo = _events(spark, sf_dir), _bounds(spark, sf_dir)[0]
    cuts = [lo, lo + dt.timedelta(days=10), lo + dt.timedelta(days=20), lo + dt.timedelta(days=9999)]
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(cuts[1]).cast("timestamp_ntz"))
    parts = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        inside = event_day("ts").between(F.lit(a), F.date_sub(F.lit(b), 1)) & ~late
        parts.append(rows.filter(inside | late if i == 2 else inside))
    return parts


def _landed_in_slices(spark, sf_dir, **options) -> str:
    """Every slice is a batch of its own: its files arrive, and the stream starts again where it was."""
    path, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    arrived = scratch_path(spark, "slices")
    for part in _arrivals(spark, sf_dir):
        part.write.option("maxRecordsPerFile", SLICE_FILE_ROWS).mode("append").parquet(arrived)
        files = spark.readStream.schema(event_feed.EVENTS_DDL).parquet(arrived)
        messages = event_feed.messages(files, dirty=True)
        stream.run_landing(
            messages, path, checkpoint, mode="landed", available_now=True, **options
        ).awaitTermination()
    return path


@query
def stream_dedup_landed(spark, sf_dir):
    """Every id once for each of its days, without state, over files that bring repeats and late rows."""
    path = _landed_in_slices(spark, sf_dir)
    return landing.read_all(spark, path).select("object_type", "object_id", "event_date")


@query
def stream_late_rows(spark, sf_dir):
    """What was too late to land, repeats included, and whether it landed all the same."""
    late = scratch_path(spark, "late")
    path = _landed_in_slices(spark, sf_dir, late_path=late)
    kept = spark.read.parquet(late).select("object_type", "object_id", "sent_dttm", "event_date")
    key = ["object_type", "object_id", "sent_dttm"]
    held = landing.read_all(spark, path).select(*key, F.lit(True).alias("landed"))
    return kept.join(held, key, "left").na.fill(False, ["landed"])


@query
def stream_land_counts(spark, sf_dir):
    return reports.row_counts(_landed_by_stream(spark, sf_dir, "exact"))


@query
def stream_fan_out_counts(spark, sf_dir):
    """Two targets written per micro-batch."""
    paths = {k.name: scratch_path(spark, k.table) for k in BY_KIND.values()}
    messages = event_feed.messages(event_feed.events_stream(spark, sf_dir), dirty=True)
    writers = {name: stream.folder_writer(path) for name, path in paths.items()}
    checkpoint = scratch_path(spark, "checkpoint")
    stream.run_fan_out(messages, writers, checkpoint, available_now=True).awaitTermination()
    kinds = [
        spark.read.parquet(path).withColumn("target", F.lit(BY_KIND[name].table))
        for name, path in paths.items()
    ]
    both = kinds[0].unionByName(kinds[1])
    return both.groupBy("target", "object_type").agg(F.count("*").alias("cnt"))


@query
def quarantine_counts(spark, sf_dir):
    dirty = event_feed.messages(_events(spark, sf_dir), dirty=True)
    return (
        parse.quarantine(parse.parse_envelope(dirty))
        .groupBy("reason", "object_type")
        .agg(F.count("*").alias("cnt"))
    )


@query
def stream_quarantine(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "quarantine"), scratch_path(spark, "checkpoint")
    messages = event_feed.messages(event_feed.events_stream(spark, sf_dir), dirty=True)
    stream.run_quarantine(messages, path, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(path).groupBy("reason").agg(F.count("*").alias("cnt"))


# --- jobs -------------------------------------------------------------------------------------


def _staged_day(spark, sf_dir, kind):
    lake = _lake(spark)
    landing.land(_landed(spark, sf_dir), lake.landing)
    staging.stage_day(spark, lake, kind, DAY)
    return spark.table(lake.table(kind))


@query
def stage_currencies_day(spark, sf_dir):
    return _staged_day(spark, sf_dir, CURRENCIES)


@query
def stage_transactions_day(spark, sf_dir):
    return _staged_day(spark, sf_dir, TRANSACTIONS)


@query
def backfill_month(spark, sf_dir):
    """Land, stage and build the mart for every day, through the tables."""
    lake = _loaded(spark, sf_dir, CURRENCIES, TRANSACTIONS)
    mart.backfill(spark, lake, *_bounds(spark, sf_dir))
    return spark.table(lake.mart).select(*MART_MEASURES)


# --- checks -----------------------------------------------------------------------------------


@query
def duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(_raw(spark, sf_dir, TRANSACTIONS), ["object_id"])


@query
def duplicate_rates(spark, sf_dir):
    day_rates = rates.with_identity(rates.rates_as_of(_cur(spark, sf_dir), DAY), DAY)
    return checks.duplicate_keys(day_rates, ["currency_code"])


@query
def null_violations(spark, sf_dir):
    landed = _landed(spark, sf_dir, dirty=True, kind=TRANSACTIONS)
    return checks.null_violations(staging.typed(landed, TRANSACTIONS), TRANSACTIONS.names)


# --- dashboard --------------------------------------------------------------------------------


@query
def dash_volume(spark, sf_dir):
    return reports.dash_volume(_mart(spark, sf_dir))


@query
def dash_avg(spark, sf_dir):
    return reports.dash_avg(_mart(spark, sf_dir))


@query
def dash_accounts(spark, sf_dir):
    return reports.dash_accounts(_mart(spark, sf_dir))


@query
def dash_turnover(spark, sf_dir):
    return reports.dash_turnover(_mart(spark, sf_dir))


@query
def dash_filtered(spark, sf_dir):
    """The dashboard with both filters set: a day range and some currencies."""
    return reports.dash_volume(_mart(spark, sf_dir), "2024-01-08", "2024-01-21", [410, 420, 450])


def _senders(spark, sf_dir):
    lake = _loaded(spark, sf_dir, CURRENCIES, TRANSACTIONS)
    mart.keep_senders(spark, lake, *_bounds(spark, sf_dir))
    return spark.table(lake.senders)


@query
def dash_unique_senders(spark, sf_dir):
    """Exact unique senders of two weeks, per currency and in all, from the stored bitmaps alone."""
    return senders.unique_senders(_senders(spark, sf_dir), "2024-01-08", "2024-01-21")


@query
def dash_running_senders(spark, sf_dir):
    """Exact unique senders from the first of the two weeks up to each day."""
    return senders.running_senders(_senders(spark, sf_dir), "2024-01-08", "2024-01-21")


# --- core layer -------------------------------------------------------------------------------


@query
def dim_accounts(spark, sf_dir):
    return core.dim_accounts(_tx(spark, sf_dir), md5_key)


@query
def dim_dates(spark, sf_dir):
    return core.dim_dates(_tx(spark, sf_dir), _cur(spark, sf_dir), md5_key)


@query
def dim_countries(spark, sf_dir):
    return core.dim_countries(_tx(spark, sf_dir), md5_key)


@query
def dim_currencies(spark, sf_dir):
    return core.dim_currencies(_tx(spark, sf_dir), _cur(spark, sf_dir), md5_key)


@query
def dim_types(spark, sf_dir):
    return core.dim_types(_tx(spark, sf_dir), md5_key)


@query
def fact_done(spark, sf_dir):
    return core.fact_done(_tx(spark, sf_dir, keep="latest"), md5_key)


@query
def rates_scd1(spark, sf_dir):
    """Rates up to the anchor day, overwritten by everything after it and of the day itself."""
    cur = _cur(spark, sf_dir)
    day = event_day("date_update")
    old, new = (
        core.rate_rows(cur.filter(side), md5_key)
        for side in (day <= F.lit(DAY).cast("date"), day >= F.lit(DAY).cast("date"))
    )
    return scd1(old, new, ["hk_rate"], rates.RATE_ORDER).select(
        "hk_rate", "date", "currency_code", "currency_code_with", "currency_with_div"
    )


def _core_loaded(spark, sf_dir) -> staging.Lake:
    """Two days of the core layer, loaded one after the other and the first one again."""
    lake = _loaded(spark, sf_dir, CURRENCIES, TRANSACTIONS)
    core_plan.ensure_core(spark, lake, "string")
    for day in (DAY, NEXT_DAY, DAY):
        core_plan.load_core_day(spark, lake, day, md5_key)
    return lake


@query
def core_facts(spark, sf_dir):
    return spark.table(_core_loaded(spark, sf_dir).core(FACT_TABLE))


@query
def core_new_accounts(spark, sf_dir):
    """Accounts with the day that brought them; the second day adds new ones only."""
    return spark.table(_core_loaded(spark, sf_dir).core("accounts"))


@query
def core_rates_upsert(spark, sf_dir):
    """Stored rates up to the anchor day, overwritten by key by everything after it and of the day."""
    lake = _lake(spark)
    core_plan.ensure_core(spark, lake, "string")
    cur, day, anchor = _cur(spark, sf_dir), event_day("date_update"), F.lit(DAY).cast("date")
    core_plan.upsert_rates(spark, lake, cur.filter(day <= anchor), md5_key)
    core_plan.upsert_rates(spark, lake, cur.filter(day >= anchor), md5_key)
    return spark.table(lake.core(RATES_TABLE)).select(
        "hk_rate", "date", "currency_code", "currency_code_with", "currency_with_div"
    )


@query
def upsert_by_object_id(spark, sf_dir):
    """First arrivals up to the anchor day, then the last arrivals from that day on."""
    day = event_day("transaction_dt")
    anchor = F.lit(DAY).cast("date")
    old = _tx(spark, sf_dir).filter(day <= anchor)
    new = _tx(spark, sf_dir, keep="latest").filter(day >= anchor)
    return scd1(old, new, ["object_id"], ["sent_dttm", "status", "amount"])


@query
def table_upsert(spark, sf_dir):
    """First arrivals up to the anchor day in the staging table, then the last ones from that day on.

    Only the days that hold a key of the new rows are read and rewritten.
    """
    table = _lake(spark).table(TRANSACTIONS)
    anchor = F.lit(DAY).cast("date")
    old = _staged(spark, sf_dir, TRANSACTIONS).filter(F.col(tables.EVENT_DAY) <= anchor)
    new = _staged(spark, sf_dir, TRANSACTIONS, "latest").filter(F.col(tables.EVENT_DAY) >= anchor)
    tables.overwrite_days(old, table)
    tables.upsert_days(new, table, ["object_id"], ["sent_dttm", "status", "amount"])
    return spark.table(table)


@query
def fk_violations(spark, sf_dir):
    """Senders that are no account because they are test accounts."""
    tx = _tx(spark, sf_dir)
    return checks.fk_violations(
        tx, core.dim_accounts(tx, md5_key), "account_number_from", "account_number"
    )
