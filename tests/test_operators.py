"""Rules of the single operators."""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from remitlake.functions import anchor_of, day_text, hash_key, partition_group
from remitlake.functions import event_day
from remitlake.operators import checks, convert, core, metrics, parse, rates, reports
from remitlake.operators.dedup import dedup_batch, scd1
from remitlake.operators.typing import split_rejects
from remitlake.plans import calendar, staging
from remitlake.schemas import CURRENCIES, TRANSACTIONS
from samples import landed, payment, rate, rates_df, tx_df, uid, values

RATES = [
    (1, "2022-10-01 10:00:00", 410, 420, "0.93"),
    (2, "2022-10-01 23:00:00", 410, 420, "0.95"),
    (3, "2022-10-03 01:00:00", 410, 420, "0.80"),
    (4, "2022-10-01 10:00:00", 410, 430, "7.00"),
    (5, "2022-10-02 10:00:00", 430, 420, "2.00"),
]


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


# --- parsing ----------------------------------------------------------------------------------


def test_quarantine_reasons(spark):
    no_id = payment(1, "2022-10-01 00:00:00") | {"object_id": None}
    messages = values(
        spark,
        [
            "not json",
            payment(2, "2022-10-01 00:00:00") | {"object_type": "PING"},
            payment(3, "2022-10-01 00:00:00") | {"object_type": None},
            payment(4, "2022-10-01 00:00:00") | {"sent_dttm": "soon"},
            payment(5, "2022-10-01 00:00:00") | {"payload": None},
            no_id,
            payment(6, "2022-10-01 00:00:00"),
        ],
    )
    parsed = parse.parse_envelope(messages)
    assert parsed.count() == 7
    bad = parse.quarantine(parsed)
    assert sorted(r.reason for r in bad.collect()) == [
        "missing field",
        "missing field",
        "missing field",
        "unknown type",
        "unknown type",
        "unparseable",
    ]
    assert parsed.filter(parse.landable()).count() == 1


def test_flatten_keeps_text_and_survives_bad_payload(spark):
    rows = landed(
        spark,
        [
            rate(1, "2022-10-01 00:00:00", 410, 0.939),
            rate(2, "2022-10-01 00:00:00", 410, 1) | {"payload": "just text"},
        ],
    )
    flat = parse.flatten_currencies(rows).orderBy("object_id").collect()
    assert (flat[0].currency_code, flat[0].currency_with_div) == ("410", "0.939")
    assert flat[1].date_update is None and flat[1].currency_code is None


def test_each_message_is_parsed_once(spark):
    rows = landed(spark, [payment(1, "2022-10-01 00:00:00")])
    staged = staging.staged(rows, TRANSACTIONS)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2  # envelope and payload


# --- typing and rejects -----------------------------------------------------------------------


def text_rows(spark, **changes):
    base = {
        "object_id": uid(1),
        "sent_dttm": "2022-10-01 00:00:00.123456",
        "operation_id": uid(1),
        "account_number_from": "1",
        "account_number_to": "2",
        "currency_code": "410",
        "country": "canada",
        "status": "done",
        "transaction_type": "c2a_incoming",
        "amount": "5",
        "transaction_dt": "2022-10-01 00:00:00",
    }
    row = {**base, **changes}
    return spark.createDataFrame([tuple(row[n] for n in TRANSACTIONS.names)], TRANSACTIONS.text_ddl)


@pytest.mark.parametrize(
    "changes, reason",
    [
        ({"amount": "abc"}, "amount: bigint"),
        ({"amount": "1.5"}, "amount: bigint"),
        ({"amount": "99999999999999999999"}, "amount: bigint"),
        ({"currency_code": "3000000000"}, "currency_code: int"),
        ({"country": "x" * 65}, "country: over 64 bytes"),
        ({"status": "x" * 33}, "status: over 32 bytes"),
        ({"object_id": "17"}, "object_id: format"),
        ({"object_id": None}, "object_id: null"),
        ({"transaction_dt": "someday"}, "transaction_dt: timestamp"),
        ({"transaction_dt": None}, "transaction_dt: null"),
        ({"country": "x" * 65, "amount": "?"}, "country: over 64 bytes; amount: bigint"),
    ],
)
def test_rejected(spark, changes, reason):
    ok, bad = split_rejects(text_rows(spark, **changes), TRANSACTIONS)
    assert ok.isEmpty()
    assert [r.reject_reason for r in bad.collect()] == [reason]


def test_accepted(spark):
    ok, bad = split_rejects(text_rows(spark, country="x" * 64, amount=None), TRANSACTIONS)
    assert bad.isEmpty()
    row = ok.first()
    assert row.amount is None
    assert row.sent_dttm == dt.datetime(2022, 10, 1, 0, 0, 0, 123000)


def test_rates_round_and_overflow(spark):
    rows = landed(
        spark,
        [
            rate(1, "2022-10-01 00:00:00", 410, "0.939"),
            rate(2, "2022-10-01 00:00:00", 410, "99999999.99"),
        ],
    )
    ok, bad = split_rejects(parse.flatten_currencies(rows), CURRENCIES)
    assert ok.first().currency_with_div == Decimal("0.94")
    assert bad.first().reject_reason == "currency_with_div: decimal(8,2)"


# --- one row per key --------------------------------------------------------------------------


def test_dedup_does_not_depend_on_row_order(spark):
    rows = [
        ("a", "2022-10-01", 1, "queued"),
        ("a", "2022-10-01", 1, "done"),
        ("a", "2022-10-01", 2, "x"),
        ("b", "2022-10-01", 5, "y"),
    ]
    seen = set()
    for order in itertools.permutations(rows):
        df = spark.createDataFrame(list(order), "id string, day string, sent int, status string")
        first = dedup_batch(df.coalesce(1), ["id", "day"], ["sent"])
        last = dedup_batch(df.coalesce(1), ["id", "day"], ["sent"], keep="latest")
        seen.add((tuple(sorted(first.collect())), tuple(sorted(last.collect()))))
        if len(seen) > 1:
            break
    ((first, last),) = seen
    assert [r.status for r in first] == ["done", "y"]
    assert [r.status for r in last] == ["x", "y"]


def test_dedup_rejects_an_unknown_choice(spark):
    with pytest.raises(ValueError):
        dedup_batch(spark.range(1), ["id"], [], keep="any")


def test_dedup_limits_keys_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as sent_dttm", "'x' as v")
    plan = dedup_batch(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    exchange, partial = plan.index("Exchange hashpartitioning"), plan.index(", 1, Partial")
    assert exchange < partial  # the partial limit is below the exchange


def test_scd1_new_side_wins(spark):
    old = spark.createDataFrame([("a", 9, "old"), ("b", 1, "old")], "k string, at int, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("a", 2, "newer")], "k string, at int, v string")
    assert as_dict(scd1(old, new, ["k"], ["at"]), "k", "v") == {"a": "newer", "b": "old"}


# --- rates and conversion ---------------------------------------------------------------------


def test_rates_as_of(spark):
    cur = rates_df(spark, RATES)
    value = "currency_with_div"
    assert as_dict(rates.rates_as_of(cur, "2022-09-30"), "currency_code", value) == {}
    # rates of the day itself count whatever the hour
    first = as_dict(rates.rates_as_of(cur, "2022-10-01"), "currency_code", value)
    assert first == {410: Decimal("0.95")}
    third = as_dict(rates.rates_as_of(cur, "2022-10-09"), "currency_code", value)
    assert third == {410: Decimal("0.80"), 430: Decimal("2.00")}


def test_equal_update_times_are_settled_by_sending(spark):
    same = "2022-10-01 10:00:00"
    cur = rates_df(
        spark,
        [
            (1, same, 410, 420, "1.00", "2022-10-01 10:00:02"),
            (2, same, 410, 420, "2.00", "2022-10-01 10:00:01"),
            (3, same, 430, 420, "3.00"),
            (4, same, 430, 420, "4.00"),
        ],
    )
    found = as_dict(rates.rates_as_of(cur, "2022-10-01"), "currency_code", "currency_with_div")
    assert found == {410: Decimal("1.00"), 430: Decimal("4.00")}


def test_rate_intervals(spark):
    rows = rates.rate_intervals(rates_df(spark, RATES)).collect()
    spans = sorted((r.currency_code, str(r.valid_from), str(r.valid_to)) for r in rows)
    assert spans == [
        (410, "2022-10-01", "2022-10-03"),
        (410, "2022-10-03", "None"),
        (430, "2022-10-02", "None"),
    ]


TX = [
    (1, "2022-09-30 10:00:00", 410, 100, 1, 2, "done"),
    (2, "2022-10-01 00:00:00", 410, 100, 1, 2, "done"),
    (3, "2022-10-02 10:00:00", 410, 100, 1, 2, "queued"),
    (4, "2022-10-03 00:30:00", 410, 100, 3, 2, "done"),
    (5, "2022-10-01 10:00:00", 420, 7, 1, 2, "done"),
    (6, "2022-10-01 10:00:00", 430, 9, 1, 2, "done"),
    (7, "2022-10-04 10:00:00", 430, 9, 1, 2, "done"),
    (8, "2022-10-04 10:00:00", 430, 9, 0, 2, "done"),
    (9, "2022-10-04 10:00:00", 430, 9, 4, -2, "done"),
]


def test_asof_convert(spark):
    out = convert.asof_convert(tx_df(spark, TX), rates_df(spark, RATES))
    assert as_dict(out, "object_id", "amount_usd") == {
        uid(2): Decimal("95.00"),
        uid(3): Decimal("95.00"),
        uid(4): Decimal("80.00"),
        uid(5): Decimal("7.00"),
        uid(7): Decimal("18.00"),
        uid(8): Decimal("18.00"),
        uid(9): Decimal("18.00"),
    }


def test_exact_day_convert(spark):
    out = convert.asof_convert(tx_df(spark, TX), rates_df(spark, RATES), mode="exact")
    assert set(as_dict(out, "object_id", "amount_usd")) == {uid(2), uid(4), uid(5)}


def test_totals_first_equals_rows_first(spark):
    tx, cur = tx_df(spark, TX), rates_df(spark, RATES + [(9, "2022-10-01 01:00:00", 420, 420, "3.00")])
    for mode in ("asof", "exact"):
        by_rows = metrics.metrics_of_converted(
            convert.asof_convert(convert.real_accounts(tx), cur, mode=mode)
        )
        by_totals = metrics.global_metrics(tx, cur, mode=mode)
        assert sorted(by_totals.collect()) == sorted(by_rows.select(by_totals.columns).collect())


def test_stored_rate_of_the_quote_currency_counts_twice(spark):
    cur = rates_df(spark, [(1, "2022-10-01 01:00:00", 420, 420, "3.00")])
    tx = tx_df(spark, [(1, "2022-10-02 10:00:00", 420, 10, 1, 2, "done")])
    row = metrics.global_metrics(tx, cur).first()
    assert (row.amount_total, row.cnt_transactions) == (Decimal("40.00"), 2)
    assert (row.avg_transactions_per_account, row.cnt_accounts_make_transactions) == (2, 1)
    identity = rates.with_identity(rates.rates_as_of(cur, "2022-10-02"), "2022-10-02")
    assert as_dict(checks.duplicate_keys(identity, ["currency_code"]), "currency_code", "copies") == {
        420: 2
    }


def test_metrics_per_day_equal_the_range(spark):
    tx, cur = tx_df(spark, TX), rates_df(spark, RATES)
    whole = metrics.global_metrics(tx, cur)
    days = [f"2022-10-{d:02d}" for d in range(1, 6)] + ["2022-09-30"]
    single = []
    for day in days:
        rows = convert.real_accounts(tx.filter(F.to_date("transaction_dt") == day))
        lookup = rates.with_identity(rates.rates_as_of(cur, day), day)
        single += metrics.metrics_of_converted(convert.convert(rows, lookup)).collect()
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(r) for r in single)


def test_metrics_options(spark):
    tx, cur = tx_df(spark, TX), rates_df(spark, RATES)
    done = metrics.global_metrics(tx, cur, statuses=["done"])
    assert "2022-10-02" not in {str(r.date_update) for r in done.collect()}
    exact = metrics.global_metrics(tx, cur).drop("avg_transactions_per_account")
    approx = metrics.global_metrics(tx, cur, approx_accounts=True)
    assert sorted(exact.collect()) == sorted(approx.select(exact.columns).collect())
    other = metrics.global_metrics(tx, cur, code=430)
    assert as_dict(other.filter("currency_from = 410"), "date_update", "amount_total")[
        dt.date(2022, 10, 2)
    ] == Decimal("700.00")
    with pytest.raises(ValueError):
        metrics.global_metrics(tx, cur, mode="nearest")


def test_average_keeps_four_decimals(spark):
    rows = [(i, "2022-10-01 10:00:00", 420, 1, 1 + i % 3, 2, "done") for i in range(10)]
    row = metrics.global_metrics(tx_df(spark, rows), rates_df(spark, RATES)).first()
    assert row.avg_transactions_per_account == Decimal("3.3333")


def test_sums_beyond_a_bigint_stay_exact(spark):
    big = 9_000_000_000_000_000
    rows = [(i, "2022-10-01 10:00:00", 420, big, 1, 2, "done") for i in range(1)]
    tx = tx_df(spark, rows).crossJoin(spark.range(1500)).drop("id")
    totals = metrics.day_totals(tx).first()
    assert totals.amount_sum == Decimal(big * 1500)


# --- keys, days, checks -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "day, group",
    [
        ("2024-05-20", "2024-05-20"),
        ("2024-03-01", "2024-03-01"),
        ("2024-02-29", "2024-02-01"),
        ("2023-01-15", "2023-01-01"),
        ("2022-12-31", "2022-01-01"),
        ("2020-07-07", "2020-01-01"),
    ],
)
def test_partition_group(spark, day, group):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert str(df.select(partition_group("d", "2024-05-31")).first()[0]) == group


def test_day_text_refuses_anything_but_a_date():
    assert day_text("2022-10-01") == day_text(dt.date(2022, 10, 1)) == "2022-10-01"
    with pytest.raises(ValueError):
        day_text("2022-10-01' OR '1'='1")


def test_anchor_dates(spark):
    rows = calendar.anchor_dates(spark, "2022-10-02", "2022-11-01").collect()
    assert len(rows) == 31
    assert (rows[0].anchor_text, rows[-1].anchor_text) == ("2022-10-01", "2022-10-31")
    assert spark.range(1).select(anchor_of(F.lit("2024-03-01").cast("date"))).first()[0] == dt.date(
        2024, 2, 29
    )


def test_only_new(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    target = spark.createDataFrame([(2,)], "k bigint")
    assert metrics.only_new(df, target, "k").collect() == [(1, "a")]


def test_null_violations(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("x", None)], "a string, b int")
    found = as_dict(checks.null_violations(df, ["a", "b"]), "column_name", "violations")
    assert found == {"a": 2, "b": 1}


def test_fact_satisfies_its_dimensions(spark):
    tx, cur = tx_df(spark, TX), rates_df(spark, RATES)
    fact = core.fact_done(tx)
    assert fact.count() == 6
    pairs = [
        ("account_number_from", core.dim_accounts(tx), "account_number"),
        ("account_number_to", core.dim_accounts(tx), "account_number"),
        ("date", core.dim_dates(tx, cur), "date"),
        ("country", core.dim_countries(tx), "country"),
        ("currency_code", core.dim_currencies(tx, cur), "currency_code"),
        ("type", core.dim_types(tx), "type"),
    ]
    for key, dim, dim_key in pairs:
        assert checks.fk_violations(fact, dim, key, dim_key).isEmpty()
    missing = checks.fk_violations(tx, core.dim_accounts(tx), "account_number_to", "account_number")
    assert as_dict(missing, "account_number_to", "violations") == {-2: 1}


def test_keys_append_to_a_dimension_once(spark):
    tx = tx_df(spark, TX)
    dim = core.dim_countries(tx)
    assert metrics.only_new(dim, dim, "hk_country").isEmpty()
    key = spark.range(1).select(hash_key(F.lit("usa"))).first()[0]
    assert dim.first().hk_country == key


def test_dashboard_filters(spark):
    mart = metrics.global_metrics(tx_df(spark, TX), rates_df(spark, RATES))
    volume = reports.dash_volume(mart, "2022-10-01", "2022-10-02", [410])
    assert sorted((str(r.date_update), r.cnt_transactions) for r in volume.collect()) == [
        ("2022-10-01", 1),
        ("2022-10-02", 1),
    ]
    turnover = as_dict(reports.dash_turnover(mart), "date_update", "amount_total")
    assert turnover[dt.date(2022, 10, 1)] == Decimal("102.00")
    assert reports.dash_avg(mart).count() == reports.dash_accounts(mart).count() == mart.count()


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2022-10-01 23:30:00", "2022-10-01"),
        ("2022-10-01", "2022-10-01"),
        ("2022-10-01T23:30:00-05:00", "2022-10-02"),
        ("10:00", None),
        ("T10:00", None),
        ("2022", None),
        ("2022-10", None),
        ("", None),
    ],
)
def test_a_day_needs_a_whole_date(spark, text, day):
    got = spark.createDataFrame([(text,)], "t string").select(event_day("t").alias("d")).first().d
    assert (got and str(got)) == day


def test_event_date_parses_a_payload_once(spark):
    messages = [payment(1, "2022-10-01 10:00:00"), rate(2, "2022-10-02 00:00:00", 410, 0.5), payment(3, "n/a")]
    dated = parse.with_event_date(parse.parse_envelope(values(spark, messages)))
    assert [str(r.event_date) for r in dated.orderBy("object_id").collect()] == ["2022-10-01", "2022-10-02", "None"]
    # One look for each kind's own field.
    assert dated._jdf.queryExecution().optimizedPlan().toString().count("get_json_object(") == 2
