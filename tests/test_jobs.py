"""Daily jobs on tables: golden run, idempotence, empty days, range against day by day."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from remitlake.operators import metrics
from remitlake.plans import mart, staging
from remitlake.schemas import CURRENCIES, TRANSACTIONS
from remitlake.sources import landing, tables
from samples import land_all, landed, payment, rate, tx_df, uid

NOW = dt.datetime(2022, 11, 1)
MESSAGES = [
    rate(1, "2022-10-01 00:00:00", 410, 0.93),
    rate(2, "2022-10-01 00:00:00", 410, 1.07, code_with=440),
    rate(3, "2022-10-03 00:00:00", 410, 0.9),
    payment(10, "2022-10-01 00:08:08", 410, -492625, 914810, 5871591),
    payment(11, "2022-10-01 00:07:44", 420, 400000, 903810, 2244989, "queued"),
    payment(12, "2022-10-01 00:32:51", 430, 150000, 903810, 685446, "queued"),
    payment(13, "2022-10-01 23:59:59", 410, 100, 914810, 7, "queued"),
    payment(13, "2022-10-02 00:00:01", 410, 100, 914810, 7, "done"),
    payment(14, "2022-10-01 12:00:00", 420, 5, -1, 7),
    payment(15, "2022-10-01 12:00:00", 420, 5, 7, 0),
    payment(16, "2022-10-03 09:00:00", 410, 1001, 5, 6),
    payment(10, "2022-10-01 00:08:08", 410, -492625, 914810, 5871591, sent="2022-10-01T00:09:00"),
]


def mart_rows(spark, lake):
    rows = spark.table(lake.mart).orderBy("date_update", "currency_from").collect()
    return [
        (
            str(r.date_update),
            r.currency_from,
            r.amount_total,
            r.cnt_transactions,
            r.avg_transactions_per_account,
            r.cnt_accounts_make_transactions,
        )
        for r in rows
    ]


EXPECTED = [
    # -492625 * 0.93 + 100 * 0.93; the repeat is gone, both rows are of one sender
    ("2022-10-01", 410, Decimal("-458048.25"), 2, Decimal("2.0000"), 1),
    # the quote currency at 1.0, test accounts left out; 430 has no rate
    ("2022-10-01", 420, Decimal("400000.00"), 1, Decimal("1.0000"), 1),
    # the same id on the next day counts there too, at the last rate before
    ("2022-10-02", 410, Decimal("93.00"), 1, Decimal("1.0000"), 1),
    ("2022-10-03", 410, Decimal("900.90"), 1, Decimal("1.0000"), 1),
]


def test_daily_runs(spark, lake):
    land_all(spark, lake, MESSAGES)
    for run in ("2022-10-02", "2022-10-03", "2022-10-04"):
        mart.run_day(spark, lake, run, now=NOW)
    assert mart_rows(spark, lake) == EXPECTED
    stored = spark.table(lake.mart).first()
    assert (stored.load_dt, stored.load_src) == (NOW, metrics.LOAD_SRC)


def test_range_run_equals_daily_runs(spark, lake):
    land_all(spark, lake, MESSAGES)
    filled = mart.run_range(spark, lake, "2022-10-02", "2022-10-05", now=NOW)
    assert filled == ["2022-10-01", "2022-10-02", "2022-10-03"]
    assert mart_rows(spark, lake) == EXPECTED


def test_repeating_a_run_changes_nothing(spark, lake):
    land_all(spark, lake, MESSAGES)
    for _ in range(2):
        mart.run_day(spark, lake, "2022-10-02", now=NOW)
    assert mart_rows(spark, lake) == EXPECTED[:2]
    assert spark.table(lake.table(TRANSACTIONS)).count() == 6


def test_staging_keeps_the_day_when_nothing_landed(spark, lake):
    land_all(spark, lake, MESSAGES)
    staging.stage_day(spark, lake, TRANSACTIONS, "2022-10-03")
    land_all(spark, lake, MESSAGES[:4], mode="overwrite")
    assert staging.stage_day(spark, lake, TRANSACTIONS, "2022-10-03") is False
    assert spark.table(lake.table(TRANSACTIONS)).count() == 1
    assert staging.stage_range(spark, lake, TRANSACTIONS, "2022-10-02", "2022-10-03") == []
    assert spark.table(lake.table(TRANSACTIONS)).count() == 1


def test_time_ordered_copy_follows_the_table(spark, lake):
    ordered = staging.Lake(lake.landing, lake.database, time_ordered=True)

    def same():
        table, copy = spark.table(lake.table(TRANSACTIONS)), spark.table(ordered.by_date(TRANSACTIONS))
        assert sorted(table.collect()) == sorted(copy.drop(tables.EVENT_MONTH).collect())
        return tables.stored_days(spark, ordered.by_date(TRANSACTIONS))

    later = [payment(20, "2022-11-05 09:00:00", 410, 5, 5, 6)]
    land_all(spark, ordered, MESSAGES + later)
    staging.stage_day(spark, ordered, TRANSACTIONS, "2022-10-01")
    assert same() == ["2022-10-01"]
    staging.stage_range(spark, ordered, TRANSACTIONS, "2022-10-02", "2022-11-30")
    assert same() == ["2022-10-01", "2022-11-01"]
    land_all(spark, ordered, [payment(20, "2022-11-05 09:00:00", 410, "abc", 5, 6)], mode="overwrite")
    staging.stage_range(spark, ordered, TRANSACTIONS, "2022-11-01", "2022-11-30")
    assert same() == ["2022-10-01"]


def test_aged_copies_rewrite_only_groups_that_grew(spark, lake):
    aged = staging.Lake(lake.landing, lake.database, aged=True)
    source, copy = lake.table(TRANSACTIONS), f"{lake.table(TRANSACTIONS)}_aged"

    def same(source=source, copy=copy):
        assert sorted(spark.table(source).collect(), key=str) == sorted(
            spark.table(copy).drop(tables.PART_GROUP).collect(), key=str
        )
        return tables.stored_days(spark, copy)

    days = ["2022-09-30", "2022-10-01", "2022-10-02", "2022-12-30", "2023-01-01"]
    land_all(spark, aged, [payment(30 + i, f"{d} 09:00:00", 410, 5, 5, 6) for i, d in enumerate(days)])
    staging.stage_range(spark, aged, TRANSACTIONS, "2022-09-30", "2022-12-30")
    assert same() == ["2022-09-01", "2022-10-01", "2022-10-02", "2022-12-30"]
    staging.stage_day(spark, aged, TRANSACTIONS, "2023-01-01")
    assert same() == ["2022-09-01", "2022-10-01", "2022-12-30", "2023-01-01"]
    again = tables.refresh_aged(spark, source, copy, ["transaction_dt"])
    assert again == [] and same()
    # an earlier date changes nothing; two years on, everything of 2022 is one group
    assert tables.refresh_aged(spark, source, copy, ["transaction_dt"], "2022-10-05") == []
    assert tables.refresh_aged(spark, source, copy, ["transaction_dt"], "2024-01-01") == ["2022-01-01"]
    assert same() == ["2022-01-01", "2023-01-01"]
    tables.drop_days(spark, source, "2022-10-02", "2022-10-02")
    tables.refresh_aged(spark, source, copy, ["transaction_dt"], days=["2022-10-02"])
    assert len(same()) == 2
    mart.backfill(spark, aged, "2022-09-30", "2023-01-01", now=NOW)
    same(lake.mart, f"{lake.mart}_aged")


def bad_day():
    return [payment(16, "2022-10-03 09:00:00", 410, "abc", 5, 6)]


def test_staging_clears_a_day_of_rejects(spark, lake):
    land_all(spark, lake, MESSAGES)
    staging.stage_day(spark, lake, TRANSACTIONS, "2022-10-03")
    land_all(spark, lake, bad_day(), mode="overwrite")
    assert staging.stage_day(spark, lake, TRANSACTIONS, "2022-10-03") is True
    assert spark.table(lake.table(TRANSACTIONS)).isEmpty()
    bad = spark.table(lake.rejects(TRANSACTIONS)).collect()
    assert [(r.object_id, r.amount, r.reject_reason) for r in bad] == [
        (uid(16), "abc", "amount: bigint")
    ]


def test_range_staging_clears_a_day_of_rejects(spark, lake):
    land_all(spark, lake, MESSAGES)
    staging.stage_range(spark, lake, TRANSACTIONS, "2022-10-01", "2022-10-03")
    land_all(spark, lake, MESSAGES[3:8] + bad_day(), mode="overwrite")
    days = staging.stage_range(spark, lake, TRANSACTIONS, "2022-10-01", "2022-10-03")
    assert days == ["2022-10-01", "2022-10-02", "2022-10-03"]
    table = lake.table(TRANSACTIONS)
    assert tables.stored_days(spark, table) == ["2022-10-01", "2022-10-02"]
    assert tables.stored_days(spark, lake.rejects(TRANSACTIONS)) == ["2022-10-03"]
    # and a day whose rejects are gone loses them
    land_all(spark, lake, MESSAGES, mode="overwrite")
    staging.stage_range(spark, lake, TRANSACTIONS, "2022-10-01", "2022-10-03")
    assert tables.stored_days(spark, lake.rejects(TRANSACTIONS)) == []


def test_mart_day_without_rows_is_cleared(spark, lake):
    land_all(spark, lake, MESSAGES)
    mart.run_range(spark, lake, "2022-10-02", "2022-10-04")
    tables.drop_days(spark, lake.table(TRANSACTIONS), "2022-10-02", "2022-10-02")
    mart.make_mart_day(spark, lake, "2022-10-02")
    days = {r[0] for r in mart_rows(spark, lake)}
    assert days == {"2022-10-01", "2022-10-03"}
    tables.drop_days(spark, lake.table(TRANSACTIONS), "2022-10-03", "2022-10-03")
    assert mart.backfill(spark, lake, "2022-10-02", "2022-10-03") == []
    assert {r[0] for r in mart_rows(spark, lake)} == {"2022-10-01"}


def test_append_new_adds_only_missing_keys(spark, lake):
    land_all(spark, lake, MESSAGES)
    mart.run_day(spark, lake, "2022-10-02")
    staging.stage_range(spark, lake, TRANSACTIONS, "2022-10-01", "2022-10-03")
    rows = metrics.mart_rows(mart.day_metrics(spark, lake, "2022-10-01", "2022-10-02"))
    for _ in range(2):
        tables.append_new(rows, lake.mart, "hk_global_metrics")
    assert mart_rows(spark, lake) == EXPECTED[:3]


def test_ensure_tables_is_repeatable(spark, lake):
    tables.ensure_tables(spark, lake.database)
    names = {t.rpartition(".")[2] for t in lake.tables(spark)}
    assert names == {
        "currencies",
        "currencies_rej",
        "transactions",
        "transactions_rej",
        "global_metrics",
        "daily_rates",
        "sender_bitmaps",
    }


def test_undated_messages_are_reported(spark, lake):
    land_all(spark, lake, [payment(1, "someday", sent="2022-10-01T00:00:00"), MESSAGES[3]])
    bad = staging.undated_rejects(spark, lake, TRANSACTIONS).collect()
    assert [(r.object_id, r.reject_reason) for r in bad] == [(uid(1), "transaction_dt: timestamp")]
    staging.stage_range(spark, lake, TRANSACTIONS, "1970-01-01", "2030-01-01")
    assert spark.table(lake.table(TRANSACTIONS)).count() == 1


def test_landing_day_reads_one_partition(spark, lake):
    land_all(spark, lake, MESSAGES)
    scan = landing.read_landing(spark, lake.landing, CURRENCIES.name, "2022-10-01")
    assert scan.count() == 2
    files = scan.select(F.input_file_name()).distinct().collect()
    assert all("object_type=CURRENCY/event_date=2022-10-01" in f[0] for f in files)


def listed(spark):
    """Files that Spark's scans have listed so far."""
    counters = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics
    return counters.METRIC_FILES_DISCOVERED().getCount()


def test_a_day_is_opened_without_listing_the_rest(spark, lake):
    import os
    import shutil

    land_all(spark, lake, MESSAGES)
    day = f"{lake.landing}/object_type=CURRENCY/event_date=2022-10-01"
    batch = os.listdir(day)[0]
    for i in range(500):
        other = f"{lake.landing}/object_type=CURRENCY/event_date=2021-{1 + i % 12:02d}-07/batch=old-{i}"
        shutil.copytree(f"{day}/{batch}", other)
    before = listed(spark)
    assert landing.read_landing(spark, lake.landing, CURRENCIES.name, "2022-10-01").count() == 2
    assert listed(spark) - before == len([f for f in os.listdir(f"{day}/{batch}") if f.endswith(".parquet")])
    before = listed(spark)
    span = landing.read_landing_range(spark, lake.landing, CURRENCIES.name, "2022-10-01", "2022-10-31")
    assert len(span.inputFiles()) == listed(spark) - before == 2
    before = listed(spark)
    assert staging.stage_day(spark, lake, CURRENCIES, "2022-10-03")
    files = [f for f in spark.table(lake.table(CURRENCIES)).inputFiles()]
    assert listed(spark) - before < 20 and files
    assert landing.read_landing(spark, lake.landing, CURRENCIES.name, "2030-01-01").count() == 0
    assert landing.read_landing_range(spark, lake.landing, "NONE", "2022-10-01", "2022-10-31").count() == 0


def test_daily_runs_join_landing_files_of_settled_days(spark, lake):
    import os

    for i in range(3):
        land_all(spark, lake, [payment(i, f"2022-10-0{d} 10:00:00") for d in (1, 2, 3)])
    day = f"{lake.landing}/object_type=TRANSACTION/event_date=2022-10-0"
    mart.run_day(spark, lake, "2022-10-04", now=NOW)
    assert [len(os.listdir(f"{day}{d}")) for d in (1, 2, 3)] == [1, 3, 3]
    mart.run_day(spark, lake, "2022-10-05", now=NOW)
    assert [len(os.listdir(f"{day}{d}")) for d in (1, 2, 3)] == [1, 1, 3]
    assert landing.read_all(spark, lake.landing).count() == 9


def test_scratch_copies_are_removed(spark, lake):
    import glob

    from remitlake.scratch import scratch_root

    land_all(spark, lake, MESSAGES)
    staging.stage_day(spark, lake, TRANSACTIONS, "2022-10-01")
    assert glob.glob(f"{scratch_root(spark)}/remitlake-transactions-2022-10-01-*") == []


def test_mart_reads_daily_rates_and_not_the_history(spark, lake):
    land_all(spark, lake, MESSAGES)
    mart.run_range(spark, lake, "2022-10-02", "2022-10-04", now=NOW)
    files = mart.day_metrics(spark, lake, "2022-10-03", "2022-10-03").inputFiles()
    assert files and not any(f"/{CURRENCIES.table}/" in f for f in files)
    days = {f.split("event_day=")[1][:10] for f in files if f"/{TRANSACTIONS.table}/" in f}
    assert days == {"2022-10-03"}


def test_a_late_rate_and_a_dropped_day_reach_the_mart(spark, lake):
    land_all(spark, lake, MESSAGES)
    mart.run_range(spark, lake, "2022-10-02", "2022-10-04", now=NOW)
    land_all(spark, lake, [rate(20, "2022-10-02 00:00:00", 410, 0.5)])
    staging.stage_day(spark, lake, CURRENCIES, "2022-10-02")
    mart.make_mart_day(spark, lake, "2022-10-02", now=NOW)
    assert (EXPECTED[2][0], 410, Decimal("50.00")) in [r[:3] for r in mart_rows(spark, lake)]
    staging.drop_range(spark, lake, CURRENCIES, "2022-10-02", "2022-10-02")
    mart.make_mart_day(spark, lake, "2022-10-02", now=NOW)
    assert mart_rows(spark, lake) == EXPECTED


def test_daily_rates_are_filled_where_they_are_missing(spark, lake):
    land_all(spark, lake, MESSAGES)
    staging.stage_range(spark, lake, CURRENCIES, "2022-10-01", "2022-10-03")
    before = sorted(spark.table(lake.daily_rates).collect())
    spark.sql(f"DROP VIEW {lake.daily_rates}")
    tables.ensure_tables(spark, lake.database)
    assert sorted(spark.table(lake.daily_rates).collect()) == before and len(before) == 3


def test_upsert_rewrites_only_days_with_the_keys(spark, lake):
    table, order = lake.table(TRANSACTIONS), ["sent_dttm", "status"]

    def rows(*spec):
        made = [(n, f"{day} 10:00:00", 410, amount, 5, 6, "done") for n, day, amount in spec]
        return tables.with_day(tx_df(spark, made), "transaction_dt")

    tables.overwrite_days(
        rows((1, "2022-10-01", 1), (2, "2022-10-01", 2), (3, "2022-10-02", 3), (4, "2022-10-03", 4)), table
    )
    new = rows((1, "2022-10-02", 10), (3, "2022-10-02", 30), (5, "2022-10-05", 50))
    days = tables.upsert_days(new, table, ["object_id"], order)
    assert days == ["2022-10-01", "2022-10-02", "2022-10-05"]
    got = sorted((int(r.object_id[-12:]), str(r.event_day), r.amount) for r in spark.table(table).collect())
    assert got == [(1, "2022-10-02", 10), (2, "2022-10-01", 2), (3, "2022-10-02", 30), (4, "2022-10-03", 4), (5, "2022-10-05", 50)]
    tables.upsert_days(rows((4, "2022-10-05", 40)), table, ["object_id"], order)
    assert "2022-10-03" not in tables.stored_days(spark, table)
    assert tables.upsert_days(new.limit(0), table, ["object_id"], order) == []


def test_landing_files_of_many_batches_are_joined(spark, lake):
    for i in range(4):
        land_all(spark, lake, [payment(i, "2022-10-01 10:00:00"), payment(9 + i, f"2022-10-0{i + 2} 10:00:00")])
    before = sorted(landing.read_all(spark, lake.landing).collect())
    assert landing.compact_landing(spark, lake.landing, "2022-10-01", "2022-10-03") == 4
    day = landing.read_landing(spark, lake.landing, TRANSACTIONS.name, "2022-10-01")
    assert day.select(F.input_file_name()).distinct().count() == 1 and day.count() == 4
    assert sorted(landing.read_all(spark, lake.landing).collect()) == before
    assert landing.compact_landing(spark, lake.landing, "2022-10-01", "2022-10-03") == 0


def test_position_settles_equal_sending_times(spark):
    messages = [payment(1, "2022-10-01 10:00:00", status=s) for s in ("b", "a", "c")]
    parsed = landed(spark, messages).coalesce(1)
    status = F.get_json_object("payload", "$.status")
    placed = parsed.withColumn("partition", F.lit(0)).withColumn(
        "offset", F.when(status == "b", 1).when(status == "a", 2).otherwise(3).cast("long")
    )
    for keep, expected in (("first", "b"), ("latest", "c")):
        assert [r.status for r in staging.extract(placed, TRANSACTIONS, keep).collect()] == [expected]
    one = staging.extract(parsed, TRANSACTIONS).collect()
    assert len(one) == 1 and one == staging.extract(parsed.repartition(3, status), TRANSACTIONS).collect()


def test_deduplication_shuffles_what_is_read(spark):
    rows = staging.staged(landed(spark, MESSAGES), TRANSACTIONS).select("amount")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [row_number" in line)
    below = plan[plan.index(window) :].splitlines()[1:]
    passed = next(line for line in below if "Project [" in line)
    assert "amount" in passed and "country" not in passed.split("concat_ws")[0]


def test_scratch_is_cleaned(spark, tmp_path):
    import os

    from remitlake import scratch

    path = scratch.scratch_path(spark, "trial")
    spark.range(3).write.parquet(path)
    assert scratch.clean(spark) >= 1 and not os.path.exists(path)
    assert scratch.clean(spark) == 0
