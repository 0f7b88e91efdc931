"""Messages and typed rows for small cases."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from remitlake.operators.parse import landable, parse_envelope
from remitlake.schemas import CURRENCIES, TRANSACTIONS
from remitlake.sources.landing import land


def uid(n: int) -> str:
    return f"00000000-0000-4000-8000-{n:012d}"


def rate(n, when, code, value, code_with=420, sent=None):
    return {
        "object_id": uid(n),
        "object_type": "CURRENCY",
        "sent_dttm": sent or when.replace(" ", "T"),
        "payload": {
            "date_update": when,
            "currency_code": code,
            "currency_code_with": code_with,
            "currency_with_div": value,
        },
    }


def payment(n, when, code=410, amount=1000, src=11, dst=22, status="done", sent=None, **other):
    return {
        "object_id": uid(n),
        "object_type": "TRANSACTION",
        "sent_dttm": sent or when.replace(" ", "T"),
        "payload": {
            "operation_id": uid(n),
            "account_number_from": src,
            "account_number_to": dst,
            "currency_code": code,
            "country": "canada",
            "status": status,
            "transaction_type": "c2a_incoming",
            "amount": amount,
            "transaction_dt": when,
            **other,
        },
    }


def values(spark, messages):
    """Topic rows from dicts, or from text for messages that are no JSON."""
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def landed(spark, messages):
    return parse_envelope(values(spark, messages)).filter(landable())


def land_all(spark, lake, messages, mode="append"):
    land(parse_envelope(values(spark, messages)), lake.landing, mode)


def when(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rates_df(spark, rows):
    """(n, date_update, code, code_with, value[, sent]) as typed rates."""
    data = [
        (uid(r[0]), when(r[5] if len(r) > 5 else r[1]), when(r[1]), r[2], r[3], Decimal(r[4]))
        for r in rows
    ]
    return spark.createDataFrame(data, CURRENCIES.ddl)


def tx_df(spark, rows):
    """(n, transaction_dt, code, amount, src, dst, status) as typed transactions."""
    data = [
        (uid(n), when(t), uid(n), src, dst, code, "usa", status, "sbp_outgoing", amount, when(t))
        for n, t, code, amount, src, dst, status in rows
    ]
    return spark.createDataFrame(data, TRANSACTIONS.ddl)


def write_lines(folder, name, messages):
    folder.mkdir(exist_ok=True)
    text = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
    (folder / name).write_text(text + "\n")
