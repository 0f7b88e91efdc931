"""Tables that readers see change once, and what is built on them."""

import datetime as dt
import threading

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from remitlake.functions import hash_key_md5
from remitlake.operators import senders
from remitlake.plans import core as core_plan
from remitlake.plans import mart, staging
from remitlake.schemas import CURRENCIES, DIMENSIONS, FACT_TABLE, RATES_TABLE, TRANSACTIONS
from remitlake.scratch import children
from remitlake.sources import generations, tables
from samples import land_all, payment, rate, rates_df, tx_df

DAYS = ["2022-10-01", "2022-10-02", "2022-10-03"]


@pytest.fixture
def notes(spark, lake):
    name = f"{lake.database}.notes"
    generations.create(spark, name, "n int, price decimal(8,2)", "day")
    return name


def rows(spark, *spec):
    return spark.createDataFrame([(n, dt.date.fromisoformat(d)) for n, d in spec], "n int, day date").withColumn("price", F.col("n") * 1.5)


def stored(spark, name):
    return sorted((r.n, str(r.day)) for r in spark.table(name).collect())


def test_publish_replace_append_discard(spark, notes):
    assert stored(spark, notes) == [] and tables.stored_days(spark, notes) == []
    assert generations.publish(rows(spark, (1, DAYS[0]), (2, DAYS[1])), notes) == DAYS[:2]
    assert generations.publish(rows(spark, (3, DAYS[1])), notes, replaced=[DAYS[0]]) == [DAYS[1]]
    assert stored(spark, notes) == [(3, DAYS[1])]
    generations.publish(rows(spark, (4, DAYS[1]), (5, DAYS[2])), notes, append=True)
    assert stored(spark, notes) == [(3, DAYS[1]), (4, DAYS[1]), (5, DAYS[2])]
    assert generations.discard(spark, notes, [DAYS[0], DAYS[1]]) == [DAYS[1]]
    assert stored(spark, notes) == [(5, DAYS[2])]
    assert generations.publish(rows(spark), notes) == [] and stored(spark, notes) == [(5, DAYS[2])]
    assert spark.table(notes).dtypes == [("n", "int"), ("price", "decimal(8,2)"), ("day", "date")]
    assert spark.table(notes).filter("day = '2022-10-01'").inputFiles() == []


def test_rows_without_a_day_are_refused(spark, notes):
    with pytest.raises(ValueError):
        generations.publish(rows(spark, (1, DAYS[0])).withColumn("day", F.lit(None).cast("date")), notes)
    assert stored(spark, notes) == []
    plain = f"{notes}_plain"
    spark.sql(f"CREATE TABLE {plain} (n int) USING parquet")
    with pytest.raises(ValueError):
        generations.live(spark, plain)


def test_a_query_that_has_begun_reads_on(spark, notes):
    generations.publish(rows(spark, (1, DAYS[0]), (2, DAYS[1])), notes)
    begun = spark.table(notes)
    begun._jdf.queryExecution().executedPlan()
    generations.publish(rows(spark, (3, DAYS[0])), notes, replaced=[DAYS[1]])
    assert sorted(r.n for r in begun.collect()) == [1, 2]
    assert stored(spark, notes) == [(3, DAYS[0])]


def test_vacuum_keeps_what_is_shown_or_young(spark, notes):
    for n in range(4):
        generations.publish(rows(spark, (n, DAYS[0]), (10 + n, DAYS[n % 3])), notes)
    before = stored(spark, notes)
    assert generations.vacuum(spark, notes, dt.timedelta(hours=1)) == 0
    # the last write and those that hold the other days
    gone = generations.vacuum(spark, notes, dt.timedelta(0))
    assert gone == 1 and stored(spark, notes) == before
    names = [t.name for t in spark.catalog.listTables(notes.split(".")[0]) if t.name.startswith("notes__")]
    assert len(names) == 1


def test_writers_of_one_driver_do_not_lose_each_other(spark, notes):
    spec = [(i, f"2022-11-{1 + i:02d}") for i in range(6)]
    threads = [threading.Thread(target=generations.publish, args=(rows(spark, s), notes)) for s in spec]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert stored(spark, notes) == spec


class Reader:
    """Reads a table before and after every statement that a job runs."""

    def __init__(self, monkeypatch, spark, table):
        self.seen, self.statements = [], []
        plain, busy = SparkSession.sql, []

        def look():
            if not busy:
                busy.append(1)
                self.seen.append(sorted(map(str, spark.table(table).collect())))
                busy.pop()

        def sql(session, text, *args, **kwargs):
            look()
            found = plain(session, text, *args, **kwargs)
            if text.startswith("ALTER VIEW") and " AS SELECT" in text and f" {table} " in text:
                self.statements.append(text)
            look()
            return found

        monkeypatch.setattr(SparkSession, "sql", sql)

    def states(self):
        return [s for i, s in enumerate(self.seen) if i == 0 or s != self.seen[i - 1]]


def test_a_reader_sees_a_backfill_at_once(spark, lake, monkeypatch):
    land_all(spark, lake, [payment(i, f"{d} 10:00:00", 420, 5, 5, 6) for i, d in enumerate(DAYS)])
    mart.run_range(spark, lake, "2022-10-02", "2022-10-04")
    staging.stage_range(spark, lake, TRANSACTIONS, DAYS[0], DAYS[2])
    tables.drop_days(spark, lake.table(TRANSACTIONS), DAYS[1], DAYS[1])
    with monkeypatch.context() as patched:
        reader = Reader(patched, spark, lake.mart)
        mart.backfill(spark, lake, DAYS[0], DAYS[2], now=dt.datetime(2022, 11, 1))
    states = reader.states()
    assert [len(s) for s in states] == [3, 2] and len(reader.statements) == 1


def test_a_reader_sees_ageing_at_once(spark, lake, monkeypatch):
    source, copy = lake.table(TRANSACTIONS), f"{lake.table(TRANSACTIONS)}_aged"
    made = [(i, f"{d} 10:00:00", 410, i, 5, 6, "done") for i, d in enumerate([*DAYS, "2022-11-01"])]
    tables.overwrite_days(tables.with_day(tx_df(spark, made), "transaction_dt"), source)
    tables.refresh_aged(spark, source, copy, ["transaction_dt"])
    assert len(tables.stored_days(spark, copy)) == 4
    with monkeypatch.context() as patched:
        reader = Reader(patched, spark, copy)
        assert tables.refresh_aged(spark, source, copy, ["transaction_dt"], "2023-01-15") == ["2022-10-01"]
    states = reader.states()
    assert [len(s) for s in states] == [4, 4] and len(reader.statements) == 1
    assert len({r.part_group for r in spark.table(copy).collect()}) == 2


def test_a_reader_sees_a_staged_range_at_once(spark, lake, monkeypatch):
    land_all(spark, lake, [payment(i, f"{d} 10:00:00") for i, d in enumerate(DAYS)])
    staging.stage_range(spark, lake, TRANSACTIONS, DAYS[0], DAYS[2])
    land_all(spark, lake, [payment(9, f"{DAYS[0]} 10:00:00"), payment(8, f"{DAYS[1]} 10:00:00", amount="abc")], mode="overwrite")
    with monkeypatch.context() as patched:
        reader = Reader(patched, spark, lake.table(TRANSACTIONS))
        staging.stage_range(spark, lake, TRANSACTIONS, DAYS[0], DAYS[2])
    assert [len(s) for s in reader.states()] == [3, 2] and len(reader.statements) == 1


# --- upserts ----------------------------------------------------------------------------------


def scanned(df):
    """Rows that the file scan of a query gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_key_lookup_skips_files_without_the_key(spark, lake):
    table = lake.table(TRANSACTIONS)
    made = [(i, f"2022-10-{1 + i % 20:02d} 10:00:00", 410, i, 5, 6, "done") for i in range(2000)]
    tables.overwrite_days(tables.with_day(tx_df(spark, made), "transaction_dt"), table, ["transaction_dt"])
    old = spark.table(table).select("event_day", "object_id")
    new = tx_df(spark, [(i, "2022-10-05 10:00:00", 410, 1, 5, 6, "done") for i in (3, 23, 7777)])
    few = tables.holding(old, ["object_id"], new)
    # 3 and 23 are of one day; 7777 is nowhere
    assert scanned(few) == 100 and few.count() == 2
    many = tx_df(spark, [(i, "2022-10-05 10:00:00", 410, 1, 5, 6, "done") for i in range(1500)])
    assert tables.holding(old, ["object_id"], many) is old
    assert tables.holding(old, ["object_id"], new.limit(0)).count() == 0
    days = tables.upsert_days(tables.with_day(new, "transaction_dt"), table, ["object_id"], ["sent_dttm"])
    assert days == ["2022-10-04", "2022-10-05"]
    assert spark.table(table).count() == 2001


# --- segments ---------------------------------------------------------------------------------


def test_segments_spare_shuffles(spark, lake):
    made = [(i, "2022-10-01 10:00:00", 410, i, 5, 6, "done") for i in range(300)]
    names = [f"{lake.database}.by_id{k}" for k in range(2)]
    for name in names:
        tables.write_clustered(tx_df(spark, made), name, ["object_id"], ["object_id"], 4)
    one, two = (spark.table(n).select("object_id", "amount") for n in names)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        from remitlake.operators.dedup import latest_per_key

        for df in (one.join(two, "object_id"), latest_per_key(one, ["object_id"], ["amount"]), one.dropDuplicates(["object_id"])):
            assert df.count() == 300
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


# --- senders ----------------------------------------------------------------------------------


def test_unique_senders_of_spans(spark):
    made = [(i, f"2022-10-0{1 + i % 5} 10:00:00", 410 if i % 3 else 420, 1, 1 + (i * 7919) % 90 * 1000, 7, "done") for i in range(400)]
    made += [(500 + i, "2022-10-02 10:00:00", 410, 1, 7, 7, "done") for i in range(50)]  # a hot sender
    made += [(600, "2022-10-02 10:00:00", 999, 1, 8, 7, "done"), (601, "2022-10-02 10:00:00", 410, 1, -8, 7, "done")]
    made += [(602, "2022-10-02 10:00:00", 410, 1, 10**12, 7, "queued"), (603, "2022-10-02 10:00:00", 410, 1, None, 7, "done")]
    cur = rates_df(spark, [(1, "2022-10-01 00:00:00", 410, 420, "0.5")])
    bitmaps = senders.sender_bitmaps(tx_df(spark, made), cur).cache()

    def brute(lo, hi, code):
        return len({src for _, t, c, _, src, *_ in made if lo <= t[:10] <= hi and c in ([410, 420] if code is None else [code]) and src and src > 0})

    for lo, hi in ((1, 5), (2, 2), (2, 4)):
        span = (f"2022-10-0{lo}", f"2022-10-0{hi}")
        got = {r.currency_from: r.unique_senders for r in senders.unique_senders(bitmaps, *span).collect()}
        assert got == {c: brute(*span, c) for c in (410, 420, None)}
        running = senders.running_senders(bitmaps, *span).collect()
        assert len(running) == 2 * (hi - lo + 1)
        for r in running:
            assert r.unique_senders == brute(span[0], str(r.date_update), r.currency_from)
    assert senders.unique_senders(bitmaps, "2030-01-01", "2030-01-02").count() == 0
    assert senders.unique_senders(bitmaps, codes=[420]).filter("currency_from IS NULL").first().unique_senders == brute("2022", "2023", 420)


def test_daily_runs_keep_the_bitmaps(spark, lake):
    land_all(spark, lake, [payment(i, f"{d} 10:00:00", 420, 5, 5 + i // 2, 6) for i, d in enumerate(DAYS)])
    for run in ("2022-10-02", "2022-10-03", "2022-10-04"):
        mart.run_day(spark, lake, run)
    total = senders.unique_senders(spark.table(lake.senders), DAYS[0], DAYS[2]).filter("currency_from IS NULL")
    assert total.first().unique_senders == 2
    tables.drop_days(spark, lake.table(TRANSACTIONS), DAYS[2], DAYS[2])
    mart.backfill(spark, lake, DAYS[0], DAYS[2])
    assert tables.stored_days(spark, lake.senders) == DAYS[:2]


# --- core layer -------------------------------------------------------------------------------


def core_lake(spark, lake):
    messages = [
        payment(1, f"{DAYS[0]} 10:00:00", 410, 5, 11, 12),
        payment(2, f"{DAYS[0]} 11:00:00", 420, 5, 11, 13, "queued"),
        payment(3, f"{DAYS[1]} 10:00:00", 410, 5, 11, 14),
        payment(4, f"{DAYS[1]} 10:00:00", 410, 5, -1, 14),
        rate(5, f"{DAYS[0]} 00:00:00", 410, 0.5),
        rate(6, f"{DAYS[0]} 12:00:00", 410, 0.6),
        rate(7, f"{DAYS[1]} 00:00:00", 430, 0.7),
    ]
    land_all(spark, lake, messages)
    for kind in (CURRENCIES, TRANSACTIONS):
        staging.stage_range(spark, lake, kind, DAYS[0], DAYS[1])
    core_plan.ensure_core(spark, lake)
    return lake


def core_rows(spark, lake):
    names = [*DIMENSIONS, FACT_TABLE, RATES_TABLE]
    return {n: sorted(map(str, spark.table(lake.core(n)).collect())) for n in names}


def test_core_load_adds_new_keys_only(spark, lake):
    core_lake(spark, lake)
    first = core_plan.load_core_day(spark, lake, DAYS[0])
    assert first == {"accounts": 3, "dates": 1, "countries": 1, "currency_codes": 2, "transaction_types": 1, "transaction_accounts": 2, FACT_TABLE: 1, RATES_TABLE: 1}
    second = core_plan.load_core_day(spark, lake, DAYS[1])
    assert second == {"accounts": 1, "dates": 1, "countries": 0, "currency_codes": 1, "transaction_types": 0, "transaction_accounts": 1, FACT_TABLE: 1, RATES_TABLE: 1}
    accounts = spark.table(lake.core("accounts")).collect()
    assert sorted((r.account_number, str(r.load_day)) for r in accounts) == [(11, DAYS[0]), (12, DAYS[0]), (13, DAYS[0]), (14, DAYS[1])]
    rates = {(str(r.date), r.currency_code): str(r.currency_with_div) for r in spark.table(lake.core(RATES_TABLE)).collect()}
    assert rates == {(DAYS[0], 410): "0.60", (DAYS[1], 430): "0.70"}
    before = core_rows(spark, lake)
    assert core_plan.load_core_day(spark, lake, DAYS[1]) == second  # the same day again
    assert core_rows(spark, lake) == before


@pytest.mark.parametrize(
    "change, check",
    [
        (lambda f: f.withColumn("country", F.lit("atlantis")), "foreign key"),
        (lambda f: f.withColumn("type", F.lit(None).cast("string")), "not null"),
        (lambda f: f.unionByName(f), "unique"),
    ],
)
def test_a_load_that_fails_its_audit_shows_nothing(spark, lake, change, check):
    core_lake(spark, lake)
    core_plan.load_core_day(spark, lake, DAYS[0])
    before = core_rows(spark, lake)
    with pytest.raises(core_plan.AuditError, match=check):
        core_plan.load_core_day(spark, lake, DAYS[1], fact=change)
    assert core_rows(spark, lake) == before
    assert core_plan.load_core_day(spark, lake, DAYS[1])[FACT_TABLE] == 1


def test_core_writes_run_at_once(spark, lake, monkeypatch):
    core_lake(spark, lake)
    both, write = threading.Barrier(2, timeout=60), generations.write_beside

    def met(*args):
        both.wait()
        return write(*args)

    monkeypatch.setattr(generations, "write_beside", met)
    assert core_plan.load_core_day(spark, lake, DAYS[0])[FACT_TABLE] == 1


def test_a_write_that_fails_leaves_no_other_write(spark, lake):
    core_lake(spark, lake)
    core_plan.load_core_day(spark, lake, DAYS[0])
    before = core_rows(spark, lake)
    folders = [generations.root(spark, lake.core(n)) for n in before]
    kept = [children(spark, folder) for folder in folders]
    with pytest.raises(ValueError, match="have no date"):
        core_plan.load_core_day(spark, lake, DAYS[1], fact=lambda f: f.withColumn("date", F.lit(None).cast("date")))
    assert core_rows(spark, lake) == before
    assert [children(spark, folder) for folder in folders] == kept


def test_core_load_of_a_day_without_rows(spark, lake):
    core_lake(spark, lake)
    assert set(core_plan.load_core_day(spark, lake, DAYS[2]).values()) == {0}


def test_stored_rates_are_overwritten_by_key(spark, lake):
    core_plan.ensure_core(spark, lake, "string")
    old = rates_df(spark, [(1, "2022-10-01 10:00:00", 410, 420, "0.5"), (2, "2022-10-02 10:00:00", 410, 420, "0.6")])
    assert core_plan.upsert_rates(spark, lake, old, hash_key_md5) == DAYS[:2]
    new = rates_df(spark, [(3, "2022-10-02 09:00:00", 410, 420, "0.7"), (4, "2022-10-02 09:30:00", 410, 420, "0.8")])
    assert core_plan.upsert_rates(spark, lake, new, hash_key_md5) == [DAYS[1]]
    kept = {str(r.date): str(r.currency_with_div) for r in spark.table(lake.core(RATES_TABLE)).collect()}
    assert kept == {DAYS[0]: "0.50", DAYS[1]: "0.80"}
