"""The same queries in DuckDB SQL, written row by row where the library aggregates first."""

from __future__ import annotations

DAY = "DATE '2024-01-15'"

FEED = """
feed AS (
  SELECT event_id, k,
    '00000000-0000-5000-8000-' || lpad(CAST(event_id // 3 AS VARCHAR), 12, '0') AS object_id,
    CASE WHEN event_type IN ('signup', 'error') THEN 'CURRENCY' ELSE 'TRANSACTION' END AS object_type,
    ts AS sent_dttm,
    user_id - 5 AS account_number_from,
    CAST(k - 2 AS BIGINT) AS account_number_to,
    CAST(410 + 10 * (user_id % 7) AS INT) AS currency_code,
    CAST(410 + 10 * (k % 7) AS INT) AS currency_code_with,
    CAST(0.5 + (k % 100) / 100.0 AS DECIMAL(8,2)) AS currency_with_div,
    CASE event_type WHEN 'view' THEN 'queued' WHEN 'click' THEN 'in_progress' ELSE 'done' END AS status,
    CAST(round(value * 100) AS BIGINT) AS amount,
    CASE user_id % 3 WHEN 0 THEN 'canada' WHEN 1 THEN 'usa' ELSE 'russia' END AS country,
    CASE WHEN user_id % 2 = 0 THEN 'sbp_outgoing' ELSE 'c2a_incoming' END AS transaction_type,
    date_trunc('second', ts) AS dt
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
)"""

_TX_COLUMNS = (
    "object_id, {sent} AS sent_dttm, object_id AS operation_id, account_number_from, "
    "account_number_to, currency_code, country, status, transaction_type, amount, "
    "dt AS transaction_dt"
)
_CUR_COLUMNS = (
    "object_id, {sent} AS sent_dttm, dt AS date_update, currency_code, currency_code_with, "
    "currency_with_div"
)
_TX_TIES = (
    "operation_id, account_number_from, account_number_to, currency_code, country, status, "
    "transaction_type, amount, transaction_dt"
)
_CUR_TIES = "date_update, currency_code, currency_code_with, currency_with_div"
_MS = "date_trunc('millisecond', feed.sent_dttm)"
_MS_OWN = "date_trunc('millisecond', sent_dttm)"


# Partition and offset of the message.
_ARRIVAL = "event_id % 8, event_id"


def _first(sent: str, way: str = "") -> str:
    """One row per id and day, the earliest sent or by ``way`` DESC the latest."""
    order = ", ".join(f"{c.strip()}{way}" for c in f"{sent}; {_ARRIVAL.replace(', ', '; ')}".split(";"))
    return f"row_number() OVER (PARTITION BY object_id, CAST(dt AS DATE) ORDER BY {order}) = 1"


TYPED = f"""
tx_raw AS (SELECT {_TX_COLUMNS.format(sent=_MS)} FROM feed WHERE object_type = 'TRANSACTION'),
cur_raw AS (SELECT {_CUR_COLUMNS.format(sent=_MS)} FROM feed WHERE object_type = 'CURRENCY'),
tx AS (SELECT {_TX_COLUMNS.format(sent=_MS)}, CAST(dt AS DATE) AS event_day FROM feed
  WHERE object_type = 'TRANSACTION' QUALIFY {_first(_MS)}),
tx_latest AS (SELECT {_TX_COLUMNS.format(sent=_MS)}, CAST(dt AS DATE) AS event_day FROM feed
  WHERE object_type = 'TRANSACTION' QUALIFY {_first(_MS, " DESC")}),
cur AS (SELECT {_CUR_COLUMNS.format(sent=_MS)}, CAST(dt AS DATE) AS event_day FROM feed
  WHERE object_type = 'CURRENCY' QUALIFY {_first(_MS)})"""

# As loaded from messages: full-precision arrival order, then typed.
TEXT = f"""
tx_us AS (SELECT {_TX_COLUMNS.format(sent="sent_dttm")} FROM feed WHERE object_type = 'TRANSACTION'),
cur_us AS (SELECT {_CUR_COLUMNS.format(sent="sent_dttm")} FROM feed WHERE object_type = 'CURRENCY'),
tx_text AS (SELECT {_TX_COLUMNS.format(sent="feed.sent_dttm")}, CAST(dt AS DATE) AS event_day
  FROM feed WHERE object_type = 'TRANSACTION' QUALIFY {_first("feed.sent_dttm")}),
tx_text_latest AS (SELECT {_TX_COLUMNS.format(sent="feed.sent_dttm")}, CAST(dt AS DATE) AS event_day
  FROM feed WHERE object_type = 'TRANSACTION' QUALIFY {_first("feed.sent_dttm", " DESC")}),
cur_text AS (SELECT {_CUR_COLUMNS.format(sent="feed.sent_dttm")}, CAST(dt AS DATE) AS event_day
  FROM feed WHERE object_type = 'CURRENCY' QUALIFY {_first("feed.sent_dttm")}),
tx AS (SELECT * REPLACE ({_MS_OWN} AS sent_dttm) FROM tx_text),
tx_latest AS (SELECT * REPLACE ({_MS_OWN} AS sent_dttm) FROM tx_text_latest),
cur AS (SELECT * REPLACE ({_MS_OWN} AS sent_dttm) FROM cur_text)"""

DIRTY = f"""
dirty AS (
  SELECT *,
    CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 1 THEN 'HEARTBEAT' ELSE object_type END AS sent_type,
    CASE WHEN k % 19 = 0 OR k % 29 = 2 THEN NULL ELSE sent_dttm END AS sent_at,
    k % 19 = 0 AS broken,
    CASE WHEN k % 31 = 3 THEN 'n/a' ELSE strftime(dt, '%Y-%m-%d %H:%M:%S') END AS dt_text,
    CASE WHEN k % 11 = 4 THEN 'abc' ELSE CAST(amount AS VARCHAR) END AS amount_text,
    CASE WHEN k % 13 = 5 THEN repeat('x', 65) ELSE country END AS country_text,
    CASE WHEN k % 17 = 6 THEN '99999999.99' ELSE CAST(currency_with_div AS VARCHAR) END AS rate_text
  FROM feed
),
landed AS (SELECT * FROM dirty
  WHERE NOT broken AND sent_type IN ('CURRENCY', 'TRANSACTION') AND sent_at IS NOT NULL),
tx_dirty AS (
  SELECT object_id, sent_at AS sent_dttm, object_id AS operation_id,
    CAST(account_number_from AS VARCHAR) AS account_number_from,
    CAST(account_number_to AS VARCHAR) AS account_number_to,
    CAST(currency_code AS VARCHAR) AS currency_code, country_text AS country, status,
    transaction_type, amount_text AS amount, dt_text AS transaction_dt,
    TRY_CAST(TRY_CAST(dt_text AS TIMESTAMP) AS DATE) AS event_day, event_id
  FROM landed WHERE sent_type = 'TRANSACTION'),
cur_dirty AS (
  SELECT object_id, sent_at AS sent_dttm, dt_text AS date_update,
    CAST(currency_code AS VARCHAR) AS currency_code,
    CAST(currency_code_with AS VARCHAR) AS currency_code_with, rate_text AS currency_with_div,
    TRY_CAST(TRY_CAST(dt_text AS TIMESTAMP) AS DATE) AS event_day, event_id
  FROM landed WHERE sent_type = 'CURRENCY'),
tx_day AS (SELECT * FROM tx_dirty WHERE event_day IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY object_id, event_day ORDER BY sent_dttm, {_ARRIVAL}) = 1),
cur_day AS (SELECT * FROM cur_dirty WHERE event_day IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY object_id, event_day ORDER BY sent_dttm, {_ARRIVAL}) = 1),
tx_judged AS (SELECT *, concat_ws('; ',
    CASE WHEN octet_length(CAST(country AS BLOB)) > 64 THEN 'country: over 64 bytes' END,
    CASE WHEN TRY_CAST(amount AS BIGINT) IS NULL THEN 'amount: bigint' END) AS reject_reason
  FROM tx_day),
cur_judged AS (SELECT *,
    CASE WHEN TRY_CAST(currency_with_div AS DECIMAL(8,2)) IS NULL
      THEN 'currency_with_div: decimal(8,2)' ELSE '' END AS reject_reason
  FROM cur_day)"""

_TX_TYPED = (
    f"object_id, {_MS_OWN} AS sent_dttm, operation_id, "
    "TRY_CAST(account_number_from AS BIGINT) AS account_number_from, "
    "TRY_CAST(account_number_to AS BIGINT) AS account_number_to, "
    "TRY_CAST(currency_code AS INT) AS currency_code, country, status, transaction_type, "
    "TRY_CAST(amount AS BIGINT) AS amount, "
    "date_trunc('second', TRY_CAST(transaction_dt AS TIMESTAMP)) AS transaction_dt"
)
_CUR_TYPED = (
    f"object_id, {_MS_OWN} AS sent_dttm, "
    "date_trunc('second', TRY_CAST(date_update AS TIMESTAMP)) AS date_update, "
    "TRY_CAST(currency_code AS INT) AS currency_code, "
    "TRY_CAST(currency_code_with AS INT) AS currency_code_with, "
    "TRY_CAST(currency_with_div AS DECIMAL(8,2)) AS currency_with_div"
)

RATES = f"""
last_known AS (SELECT currency_code, max((date_update, sent_dttm, object_id, currency_with_div)) AS best
  FROM cur WHERE currency_code_with = 420 AND event_day <= {DAY} GROUP BY currency_code),
day_rates AS (SELECT currency_code, 420 AS currency_code_with, best[4] AS currency_with_div,
    CAST(best[1] AS DATE) AS date_update FROM last_known),
day_rates_420 AS (SELECT * FROM day_rates
  UNION ALL SELECT 420, 420, CAST(1.0 AS DECIMAL(8,2)), {DAY}),
daily AS (SELECT currency_code, event_day AS rate_day, currency_with_div FROM cur
  WHERE currency_code_with = 420
  QUALIFY row_number() OVER (PARTITION BY currency_code, event_day
    ORDER BY date_update DESC, sent_dttm DESC, object_id DESC) = 1),
days AS (SELECT DISTINCT event_day FROM tx),
rate_asof AS (SELECT currency_code, event_day, currency_with_div FROM days JOIN daily ON rate_day <= event_day
  QUALIFY row_number() OVER (PARTITION BY currency_code, event_day ORDER BY rate_day DESC) = 1
  UNION ALL SELECT 420, event_day, 1.00 FROM days),
rate_exact AS (SELECT currency_code, rate_day AS event_day, currency_with_div FROM daily
  UNION ALL SELECT 420, event_day, 1.00 FROM days)"""


def _with(body: str, *parts: str) -> str:
    return f"WITH {','.join((FEED, *parts))}\n{body}"


def _metrics(where: str = "TRUE", tx: str = "tx", lookup: str = "rate_asof") -> str:
    """Converted row by row, then grouped; the average rounds half up in integers."""
    return f"""
  SELECT date_update, currency_from, amount_total, cnt_transactions,
    CAST(((20000 * cnt_transactions + acc) // (2 * acc)) / 10000.0 AS DECIMAL(12,4))
      AS avg_transactions_per_account,
    acc AS cnt_accounts_make_transactions
  FROM (SELECT t.event_day AS date_update, t.currency_code AS currency_from,
      CAST(SUM(CAST(t.amount AS DECIMAL(18,0)) * CAST(c.currency_with_div AS DECIMAL(8,2)))
        AS DECIMAL(18,2)) AS amount_total,
      COUNT(*) AS cnt_transactions, COUNT(DISTINCT t.account_number_from) AS acc
    FROM {tx} t JOIN {lookup} c ON c.currency_code = t.currency_code AND c.event_day = t.event_day
    WHERE t.account_number_from > 0 AND t.account_number_to > 0 AND ({where})
    GROUP BY t.event_day, t.currency_code)"""


MART = f"mart AS ({_metrics()})"
DONE_DAY = f"""done_day AS ({_metrics(f"t.status = 'done' AND t.event_day = {DAY}")})"""
REAL = "account_number_from > 0 AND account_number_to > 0"
_TX_ALL = "* EXCLUDE (event_day)"


def _mart(body: str) -> str:
    return _with(body, TYPED, RATES, MART)


def _measure(name: str) -> str:
    return _mart(f"SELECT date_update, currency_from, {name} FROM mart")


def _dim(values: str, name: str, key: str) -> str:
    return (
        f"SELECT md5(CAST({name} AS VARCHAR)) AS {key}, {name} "
        f"FROM (SELECT DISTINCT {name} FROM ({values})) WHERE {name} IS NOT NULL"
    )


def _across(lookup: str) -> str:
    return _with(
        f"""SELECT t.object_id, t.event_day AS day, t.currency_code, c.currency_with_div,
          CAST(t.amount * c.currency_with_div AS DECIMAL(29,2)) AS amount_usd
        FROM (SELECT * REPLACE (CAST(amount AS DECIMAL(20,0)) AS amount) FROM tx WHERE {REAL}) t
        JOIN {lookup} c ON c.currency_code = t.currency_code AND c.event_day = t.event_day""",
        TYPED,
        RATES,
    )


def _one_day(select: str) -> str:
    return _with(
        f"""SELECT {select} FROM (SELECT * FROM tx WHERE event_day = {DAY} AND {REAL}) t
        JOIN day_rates_420 c ON c.currency_code = t.currency_code""",
        TYPED,
        RATES,
    )


_LANDED = _with("SELECT object_type, COUNT(*) AS cnt FROM feed GROUP BY object_type")
_STREAM_KEYS = _with("SELECT DISTINCT sent_type AS object_type, object_id FROM landed", DIRTY)
_REASON = """CASE WHEN broken THEN 'unparseable'
  WHEN sent_type NOT IN ('CURRENCY', 'TRANSACTION') THEN 'unknown type' ELSE 'missing field' END"""
_QUARANTINED = (
    "(broken OR sent_type NOT IN ('CURRENCY', 'TRANSACTION') OR sent_at IS NULL)"
)


# Transactions of two weeks that the mart counts.
_SENT = f"""tx t JOIN rate_asof c ON c.currency_code = t.currency_code AND c.event_day = t.event_day
  AND t.event_day BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND {REAL}"""
_TWO_DAYS = f"event_day BETWEEN {DAY} AND {DAY} + 1"


def all_sql() -> dict[str, str]:
    text = {c: f"CAST({c} AS VARCHAR) AS {c}" for c in (_TX_TIES + ", " + _CUR_TIES).split(", ")}
    tx_text = "object_id, sent_dttm, " + ", ".join(text[c] for c in _TX_TIES.split(", "))
    # JSON numbers come back from Spark without trailing zeros.
    text["currency_with_div"] = (
        "CAST(CAST(currency_with_div AS DOUBLE) AS VARCHAR) AS currency_with_div"
    )
    cur_text = "object_id, sent_dttm, " + ", ".join(text[c] for c in _CUR_TIES.split(", "))
    return {
        # sources, sinks, layout
        "peek_messages": _with(
            """SELECT CASE object_type WHEN 'CURRENCY' THEN 'rates' ELSE 'payments' END AS topic,
              CAST(event_id % 8 AS INT) AS partition, event_id AS "offset",
              object_id, object_type, sent_dttm
            FROM feed ORDER BY event_id LIMIT 701"""
        ),
        "peek_per_topic": _with(
            """SELECT topic, partition, "offset", object_id, object_type, sent_dttm FROM (
              SELECT CASE object_type WHEN 'CURRENCY' THEN 'rates' ELSE 'payments' END AS topic,
                CAST(event_id % 8 AS INT) AS partition, event_id AS "offset",
                object_id, object_type, sent_dttm FROM feed)
            QUALIFY row_number() OVER (PARTITION BY topic ORDER BY partition, "offset") <= 8"""
        ),
        "land_counts": _LANDED,
        "landing_day_scan": _with(
            f"""SELECT object_id, object_type, sent_dttm, CAST(dt AS DATE) AS event_date FROM feed
            WHERE object_type = 'TRANSACTION' AND CAST(dt AS DATE) = {DAY}"""
        ),
        "rejects_ok": _with(
            f"SELECT {_TX_TYPED} FROM tx_judged WHERE reject_reason = ''", DIRTY
        ),
        "rejects_bad": _with(
            "SELECT * EXCLUDE (event_day, event_id) FROM tx_judged WHERE reject_reason <> ''", DIRTY
        ),
        "rejects_ok_currencies": _with(
            f"SELECT {_CUR_TYPED} FROM cur_judged WHERE reject_reason = ''", DIRTY
        ),
        "rejects_bad_currencies": _with(
            "SELECT * EXCLUDE (event_day, event_id) FROM cur_judged WHERE reject_reason <> ''", DIRTY
        ),
        "rejects_undated": _with(
            """SELECT * EXCLUDE (event_day, event_id), concat_ws('; ',
              CASE WHEN octet_length(CAST(country AS BLOB)) > 64 THEN 'country: over 64 bytes' END,
              CASE WHEN TRY_CAST(amount AS BIGINT) IS NULL THEN 'amount: bigint' END,
              'transaction_dt: timestamp') AS reject_reason
            FROM tx_dirty WHERE event_day IS NULL""",
            DIRTY,
        ),
        "csv_round_trip": _with(
            f"SELECT {_TX_TYPED} FROM tx_judged WHERE reject_reason = ''", DIRTY
        ),
        "csv_line_breaks": _with(
            """SELECT object_id, account_number_from,
              status || chr(10) || '"\\n,' || chr(13) || '\\' || country || '\\\\' || chr(10) AS note
            FROM tx""",
            TYPED,
        ),
        "stage_replace_day": _with(
            f"""SELECT * FROM tx WHERE event_day <> {DAY}
            UNION ALL SELECT * FROM tx_latest WHERE event_day = {DAY}""",
            TEXT,
        ),
        "mart_replace_day": _with(
            f"SELECT * FROM mart WHERE date_update <> {DAY} UNION ALL SELECT * FROM done_day",
            TEXT,
            RATES,
            MART,
            DONE_DAY,
        ),
        "drop_days_remaining": _with(
            """SELECT event_day, COUNT(*) AS cnt FROM cur
            WHERE event_day NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' GROUP BY event_day""",
            TEXT,
        ),
        "mart_append_new": _with(
            """SELECT * FROM done_day UNION ALL SELECT * FROM mart m WHERE NOT EXISTS (
              SELECT 1 FROM done_day d
              WHERE d.date_update = m.date_update AND d.currency_from = m.currency_from)""",
            TEXT,
            RATES,
            MART,
            DONE_DAY,
        ),
        "day_partition_counts": _with(
            "SELECT event_day, COUNT(*) AS cnt FROM tx GROUP BY event_day", TEXT
        ),
        "partition_groups": """SELECT day, cnt, CAST(CASE
              WHEN datediff('year', day, DATE '1998-06-15') >= 2 THEN date_trunc('year', day)
              WHEN datediff('month', day, DATE '1998-06-15') >= 3 THEN date_trunc('month', day)
              ELSE day END AS DATE) AS part_group
            FROM (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS cnt FROM orders GROUP BY 1)""",
        "compacted_days": _with(
            """SELECT DATE '2024-01-01' AS part_group, event_day, COUNT(*) AS cnt,
              CAST(SUM(amount) AS BIGINT) AS amount
            FROM tx GROUP BY event_day""",
            TYPED,
        ),
        "aged_refresh": _with(
            """SELECT DATE '2024-01-01' AS part_group, event_day, COUNT(*) AS cnt,
              CAST(SUM(amount) AS BIGINT) AS amount
            FROM tx GROUP BY event_day""",
            TEXT,
        ),
        "by_date_refresh": _with(f"SELECT * FROM cur WHERE event_day <> {DAY}", TEXT),
        "clustered_join": _with(
            """SELECT tx.object_id, tx.event_day, tx.status, tx_latest.status AS last_status
            FROM tx JOIN tx_latest USING (object_id, event_day)""",
            TYPED,
        ),
        "clustered_copy": _with(f"SELECT {_TX_ALL} FROM tx", TYPED),
        "by_date_copy": _with(f"SELECT {_TX_ALL} FROM cur", TYPED),
        "by_date_copy_transactions": _with(f"SELECT {_TX_ALL} FROM tx", TYPED),
        # projections, filters
        "parse_envelope": _with(
            """SELECT event_id AS "offset", object_id, object_type, sent_dttm,
              CAST(currency_code AS VARCHAR) AS currency_code FROM feed"""
        ),
        "route_currency": _with(
            """SELECT event_id AS "offset", object_id, object_type, sent_dttm FROM feed
            WHERE object_type = 'CURRENCY'"""
        ),
        "route_transaction": _with(
            """SELECT event_id AS "offset", object_id, object_type, sent_dttm FROM feed
            WHERE object_type = 'TRANSACTION'"""
        ),
        "flatten_currencies": _with(f"SELECT {cur_text} FROM cur_us", TEXT),
        "flatten_transactions": _with(f"SELECT {tx_text} FROM tx_us", TEXT),
        "typed_currencies": _with(f"SELECT {_CUR_TYPED} FROM cur_dirty", DIRTY),
        "typed_transactions": _with(f"SELECT {_TX_TYPED} FROM tx_dirty", DIRTY),
        "filter_day": _with(
            f"SELECT * FROM tx_raw WHERE CAST(transaction_dt AS DATE) = {DAY}", TYPED
        ),
        "rates_to_usd": _with(
            f"SELECT {_TX_ALL} FROM cur WHERE currency_code_with = 420", TYPED
        ),
        "rates_as_of_day": _with("SELECT * FROM day_rates", TYPED, RATES),
        "rates_with_identity": _with("SELECT * FROM day_rates_420", TYPED, RATES),
        "real_accounts": _with(f"SELECT {_TX_ALL} FROM tx WHERE {REAL}", TYPED),
        "status_done_metrics": _with(_metrics("t.status = 'done'"), TYPED, RATES),
        "mart_audit": _mart(
            """SELECT date_update, currency_from, TIMESTAMP '2024-02-01 00:00:00' AS load_dt,
              'daily run' AS load_src FROM mart"""
        ),
        "param_sql": _with(
            f"""SELECT status, transaction_type, COUNT(*) AS cnt,
              CAST(SUM(amount) AS BIGINT) AS amount
            FROM tx WHERE event_day = {DAY} GROUP BY status, transaction_type""",
            TYPED,
        ),
        # joins
        "join_rates": _one_day("t.object_id, t.currency_code, c.currency_with_div"),
        "amount_usd": _one_day(
            """t.object_id, t.amount,
            CAST(CAST(t.amount AS DECIMAL(20,0)) * c.currency_with_div AS DECIMAL(29,2))
              AS amount_usd"""
        ),
        "asof_convert": _across("rate_asof"),
        "exact_day_convert": _across("rate_exact"),
        "exact_day_metrics": _with(_metrics(lookup="rate_exact"), TYPED, RATES),
        "rate_intervals": _with(
            """SELECT currency_code, rate_day AS valid_from,
              lead(rate_day) OVER (PARTITION BY currency_code ORDER BY rate_day) AS valid_to,
              currency_with_div FROM daily""",
            TYPED,
            RATES,
        ),
        "only_new": _with(
            """SELECT * FROM mart m WHERE NOT EXISTS (SELECT 1 FROM done_day d
              WHERE d.date_update = m.date_update AND d.currency_from = m.currency_from)""",
            TYPED,
            RATES,
            MART,
            DONE_DAY,
        ),
        # aggregates
        "global_metrics_day": _with(
            f"""SELECT *, md5(CAST(date_update AS VARCHAR) || '|' || CAST(currency_from AS VARCHAR))
              AS hk_md5 FROM mart WHERE date_update = {DAY}""",
            TEXT,
            RATES,
            MART,
        ),
        "global_metrics_month": _with("SELECT * FROM mart", TEXT, RATES, MART),
        "backfill_month": _with("SELECT * FROM mart", TEXT, RATES, MART),
        "amount_total": _measure("amount_total"),
        "cnt_transactions": _measure("cnt_transactions"),
        "cnt_accounts": _measure("cnt_accounts_make_transactions"),
        "avg_per_account": _measure("avg_transactions_per_account"),
        "distinct_rates": _with(
            """SELECT DISTINCT currency_code, currency_code_with, currency_with_div FROM cur
            WHERE currency_code_with = 420""",
            TYPED,
        ),
        "profile_by_day": _with(
            """SELECT event_day AS anchor_date, COUNT(*) AS cnt FROM tx_dirty
            GROUP BY event_day ORDER BY event_day NULLS FIRST""",
            DIRTY,
        ),
        # one row per key
        "latest_rate_first_value": _with(
            """SELECT object_id, sent_dttm, date_update, currency_code, currency_code_with, currency_with_div
            FROM cur WHERE currency_code_with = 420
            QUALIFY row_number() OVER (PARTITION BY currency_code
              ORDER BY date_update DESC, sent_dttm DESC, object_id DESC) = 1""",
            TYPED,
        ),
        "dedup_currencies": _with(f"SELECT {cur_text}, event_day FROM cur_text", TEXT),
        "dedup_transactions": _with(f"SELECT {tx_text}, event_day FROM tx_text", TEXT),
        "dedup_latest": _with("SELECT * FROM tx_latest", TYPED),
        # functions
        "hash_key_md5": _with(
            """SELECT object_id, md5(CAST(CAST(transaction_dt AS DATE) AS VARCHAR) || '|' ||
              CAST(currency_code AS VARCHAR)) AS hk FROM tx_raw""",
            TYPED,
        ),
        "anchor_dates": """SELECT run_date, CAST(run_date - INTERVAL 1 DAY AS DATE) AS anchor_date,
              strftime(run_date - INTERVAL 1 DAY, '%Y-%m-%d') AS anchor_text
            FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS run_date
              FROM (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM events))""",
        # streaming
        "stream_dedup_exact": _STREAM_KEYS,
        "stream_dedup_bounded": _STREAM_KEYS,
        "stream_dedup_landed": _with(
            """SELECT DISTINCT sent_type AS object_type, object_id,
              TRY_CAST(TRY_CAST(dt_text AS TIMESTAMP) AS DATE) AS event_date FROM landed""",
            DIRTY,
        ),
        "stream_late_rows": _with(
            """SELECT sent_type AS object_type, object_id, sent_dttm,
              TRY_CAST(TRY_CAST(dt_text AS TIMESTAMP) AS DATE) AS event_date, FALSE AS landed
            FROM landed WHERE event_id % 50 = 0
              AND sent_dttm < (SELECT CAST(min(ts) AS DATE) + INTERVAL 10 DAY FROM events)""",
            DIRTY,
        ),
        "stream_land_counts": _with(
            """SELECT sent_type AS object_type, COUNT(DISTINCT object_id) AS cnt FROM landed
            GROUP BY sent_type""",
            DIRTY,
        ),
        "stream_fan_out_counts": _with(
            """SELECT CASE sent_type WHEN 'CURRENCY' THEN 'currencies' ELSE 'transactions' END
              AS target, sent_type AS object_type, COUNT(DISTINCT object_id) AS cnt
            FROM landed GROUP BY sent_type""",
            DIRTY,
        ),
        "quarantine_counts": _with(
            f"""SELECT {_REASON} AS reason, sent_type AS object_type, COUNT(*) AS cnt FROM dirty
            WHERE {_QUARANTINED} GROUP BY ALL""",
            DIRTY,
        ),
        "stream_quarantine": _with(
            f"""SELECT {_REASON} AS reason, COUNT(*) AS cnt FROM dirty
            WHERE {_QUARANTINED} GROUP BY ALL""",
            DIRTY,
        ),
        # jobs
        "stage_currencies_day": _with(f"SELECT * FROM cur WHERE event_day = {DAY}", TEXT),
        "stage_transactions_day": _with(f"SELECT * FROM tx WHERE event_day = {DAY}", TEXT),
        # checks
        "duplicate_keys": _with(
            """SELECT object_id, COUNT(*) AS copies FROM tx_raw GROUP BY object_id
            HAVING COUNT(*) > 1""",
            TYPED,
        ),
        "duplicate_rates": _with(
            """SELECT currency_code, COUNT(*) AS copies FROM day_rates_420
            GROUP BY currency_code HAVING COUNT(*) > 1""",
            TYPED,
            RATES,
        ),
        "null_violations": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS violations FROM t"
                for c in ("object_id, sent_dttm, " + _TX_TIES).split(", ")
            ),
            DIRTY,
            f"t AS (SELECT {_TX_TYPED} FROM tx_dirty)",
        ),
        # dashboard
        "dash_volume": _measure("cnt_transactions"),
        "dash_avg": _measure("avg_transactions_per_account"),
        "dash_accounts": _measure("cnt_accounts_make_transactions"),
        "dash_turnover": _mart(
            """SELECT date_update, CAST(SUM(amount_total) AS DECIMAL(38,2)) AS amount_total
            FROM mart GROUP BY date_update"""
        ),
        "dash_filtered": _mart(
            """SELECT date_update, currency_from, cnt_transactions FROM mart
            WHERE date_update BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
              AND currency_from IN (410, 420, 450)"""
        ),
        "dash_unique_senders": _with(
            f"""SELECT t.currency_code AS currency_from, COUNT(DISTINCT account_number_from) AS unique_senders
            FROM {_SENT} GROUP BY GROUPING SETS ((t.currency_code), ())""",
            TEXT,
            RATES,
        ),
        "dash_running_senders": _with(
            f"""SELECT d.event_day AS date_update, d.currency_code AS currency_from,
              COUNT(DISTINCT s.account_number_from) AS unique_senders
            FROM (SELECT DISTINCT t.event_day, t.currency_code FROM {_SENT}) d
            JOIN (SELECT t.event_day, t.currency_code, account_number_from FROM {_SENT}) s
              ON s.currency_code = d.currency_code AND s.event_day <= d.event_day
            GROUP BY d.event_day, d.currency_code""",
            TEXT,
            RATES,
        ),
        # core layer
        "dim_accounts": _with(
            _dim(
                f"""SELECT account_number_from AS account_number FROM tx WHERE {REAL}
                UNION ALL SELECT account_number_to FROM tx WHERE {REAL}""",
                "account_number",
                "hk_account_number",
            ),
            TYPED,
        ),
        "dim_dates": _with(
            _dim(
                'SELECT event_day AS "date" FROM tx UNION ALL SELECT event_day FROM cur',
                '"date"',
                "hk_date",
            ),
            TYPED,
        ),
        "dim_countries": _with(_dim("SELECT country FROM tx", "country", "hk_country"), TYPED),
        "dim_currencies": _with(
            _dim(
                """SELECT currency_code FROM tx UNION ALL SELECT currency_code FROM cur
                UNION ALL SELECT currency_code_with FROM cur""",
                "currency_code",
                "hk_currency",
            ),
            TYPED,
        ),
        "dim_types": _with(
            _dim('SELECT transaction_type AS "type" FROM tx', '"type"', "hk_type"), TYPED
        ),
        "fact_done": _with(
            f"""SELECT md5(operation_id) AS hk, operation_id, account_number_from,
              account_number_to, transaction_dt, event_day AS "date", currency_code, country,
              transaction_type AS "type", amount
            FROM tx_latest WHERE status = 'done' AND {REAL}""",
            TYPED,
        ),
        "rates_scd1": _with(
            """SELECT md5(CAST(event_day AS VARCHAR) || '|' || CAST(currency_code AS VARCHAR)
                || '|' || CAST(currency_code_with AS VARCHAR)) AS hk_rate,
              event_day AS "date", currency_code, currency_code_with, currency_with_div
            FROM cur QUALIFY row_number() OVER (
              PARTITION BY event_day, currency_code, currency_code_with
              ORDER BY date_update DESC, sent_dttm DESC, object_id DESC) = 1""",
            TYPED,
        ),
        "core_facts": _with(
            f"""SELECT md5(operation_id) AS hk, operation_id, account_number_from,
              account_number_to, transaction_dt, event_day AS "date", currency_code, country,
              transaction_type AS "type", amount
            FROM tx WHERE status = 'done' AND {REAL} AND {_TWO_DAYS}""",
            TEXT,
        ),
        "core_new_accounts": _with(
            f"""SELECT md5(CAST(n AS VARCHAR)) AS hk_account_number, n AS account_number,
              first_seen AS load_day
            FROM (SELECT n, CASE WHEN bool_or(event_day = {DAY}) THEN {DAY} ELSE min(event_day) END
                AS first_seen
              FROM (SELECT account_number_from AS n, event_day FROM tx WHERE {REAL} AND {_TWO_DAYS}
                UNION ALL SELECT account_number_to, event_day FROM tx WHERE {REAL} AND {_TWO_DAYS})
              GROUP BY n)""",
            TEXT,
        ),
        "core_rates_upsert": _with(
            """SELECT md5(CAST(event_day AS VARCHAR) || '|' || CAST(currency_code AS VARCHAR)
                || '|' || CAST(currency_code_with AS VARCHAR)) AS hk_rate,
              event_day AS "date", currency_code, currency_code_with, currency_with_div
            FROM cur QUALIFY row_number() OVER (
              PARTITION BY event_day, currency_code, currency_code_with
              ORDER BY date_update DESC, sent_dttm DESC, object_id DESC) = 1""",
            TYPED,
        ),
        "upsert_by_object_id": _with(
            f"""SELECT * EXCLUDE (event_day, side) FROM (
              SELECT *, 0 AS side FROM tx WHERE event_day <= {DAY}
              UNION ALL SELECT *, 1 AS side FROM tx_latest WHERE event_day >= {DAY})
            QUALIFY row_number() OVER (PARTITION BY object_id
              ORDER BY side DESC, sent_dttm DESC, status DESC, amount DESC) = 1""",
            TYPED,
        ),
        "table_upsert": _with(
            f"""SELECT * FROM tx WHERE event_day <= {DAY}
              AND object_id NOT IN (SELECT object_id FROM tx_latest WHERE event_day >= {DAY})
            UNION ALL SELECT * FROM (SELECT * FROM tx_latest WHERE event_day >= {DAY}
              QUALIFY row_number() OVER (PARTITION BY object_id
                ORDER BY sent_dttm DESC, status DESC, amount DESC) = 1)""",
            TYPED,
        ),
        "fk_violations": _with(
            f"""SELECT account_number_from, COUNT(*) AS violations FROM tx
            WHERE account_number_from NOT IN (SELECT account_number_from FROM tx WHERE {REAL}
              UNION ALL SELECT account_number_to FROM tx WHERE {REAL})
            GROUP BY account_number_from""",
            TYPED,
        ),
    }
