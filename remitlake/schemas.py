"""Declared shapes. Nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the data model.
CURRENCY = "CURRENCY"
TRANSACTION = "TRANSACTION"
KINDS = (CURRENCY, TRANSACTION)
USD = 420
UUID_PATTERN = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

ENVELOPE = "object_id string, object_type string, sent_dttm timestamp, payload string"


@dataclass(frozen=True)
class Field:
    """One staging column and what its text must satisfy to be loaded."""

    name: str
    type: str
    grain: str | None = None
    max_bytes: int | None = None
    pattern: str | None = None
    required: bool = False


@dataclass(frozen=True)
class Kind:
    """One message kind: its table, its event-time field and its typed columns."""

    name: str
    table: str
    event_time: str
    fields: tuple[Field, ...]

    @property
    def payload_names(self) -> list[str]:
        return [f.name for f in self.fields if f.name not in ("object_id", "sent_dttm")]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"{f.name} {f.type}" for f in self.fields)

    @property
    def text_ddl(self) -> str:
        return ", ".join(f"{f.name} string" for f in self.fields)


_ENVELOPE_FIELDS = (
    Field("object_id", "string", pattern=UUID_PATTERN, required=True),
    Field("sent_dttm", "timestamp", grain="MILLISECOND"),
)

CURRENCIES = Kind(
    name=CURRENCY,
    table="currencies",
    event_time="date_update",
    fields=_ENVELOPE_FIELDS
    + (
        Field("date_update", "timestamp", grain="SECOND", required=True),
        Field("currency_code", "int"),
        Field("currency_code_with", "int"),
        Field("currency_with_div", "decimal(8,2)"),
    ),
)

TRANSACTIONS = Kind(
    name=TRANSACTION,
    table="transactions",
    event_time="transaction_dt",
    fields=_ENVELOPE_FIELDS
    + (
        Field("operation_id", "string", pattern=UUID_PATTERN),
        Field("account_number_from", "bigint"),
        Field("account_number_to", "bigint"),
        Field("currency_code", "int"),
        Field("country", "string", max_bytes=64),
        Field("status", "string", max_bytes=32),
        Field("transaction_type", "string", max_bytes=32),
        Field("amount", "bigint"),
        Field("transaction_dt", "timestamp", grain="SECOND", required=True),
    ),
)

BY_KIND = {CURRENCY: CURRENCIES, TRANSACTION: TRANSACTIONS}
BY_TABLE = {k.table: k for k in BY_KIND.values()}

DAILY_RATES = "daily_rates"
MART_TABLE = "global_metrics"
MART_DDL = (
    "hk_global_metrics bigint, currency_from int, amount_total decimal(18,2), "
    "cnt_transactions bigint, avg_transactions_per_account decimal(12,4), "
    "cnt_accounts_make_transactions bigint, load_dt timestamp, load_src string"
)
SENDERS = "sender_bitmaps"
SENDERS_DDL = "currency_from int, bucket bigint, senders binary"
MART_COLUMNS = [
    "hk_global_metrics",
    "date_update",
    "currency_from",
    "amount_total",
    "cnt_transactions",
    "avg_transactions_per_account",
    "cnt_accounts_make_transactions",
    "load_dt",
    "load_src",
]

# The core layer: a dimension's key, value and its type. A day's load adds the values that are new.
DIMENSIONS = {
    "accounts": ("hk_account_number", "account_number", "bigint"),
    "dates": ("hk_date", "date", "date"),
    "countries": ("hk_country", "country", "string"),
    "currency_codes": ("hk_currency", "currency_code", "int"),
    "transaction_types": ("hk_type", "type", "string"),
    "transaction_accounts": ("hk_id", "id", "bigint"),
}
FACT_TABLE = "transactions_done"
FACT_DDL = (
    "hk {key}, operation_id string, account_number_from bigint, account_number_to bigint, "
    "transaction_dt timestamp, currency_code int, country string, type string, amount bigint"
)
RATES_TABLE = "currency_rates"
RATES_DDL = (
    "hk_rate {key}, currency_code int, currency_code_with int, currency_with_div decimal(8,2), "
    "date_update timestamp, sent_dttm timestamp, object_id string"
)
