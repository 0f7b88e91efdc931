"""Messages to columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import event_day
from remitlake.schemas import BY_KIND, CURRENCIES, ENVELOPE, KINDS, TRANSACTIONS, Kind

_TIME = "__time"


def _parsed(df: DataFrame, text: Column, schema: str, keep: Sequence[str]) -> DataFrame:
    """The fields of JSON text as columns beside ``keep``, in exactly one parse per row.

    As a generator, the parse is a fixed step of the plan. As a projection Catalyst would push every
    later filter on a field below it, each with a parse of its own.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def parse_envelope(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Decode ``value`` and flatten the envelope; the nested payload stays JSON text.

    Text that is no JSON gives a row of nulls. ``keep`` names source columns to carry along.
    """
    return _parsed(df, F.col("value").cast("string"), ENVELOPE, keep)


def landable() -> Column:
    """True for rows the landing tables accept: a known type and no null column. Never null."""
    known = F.col("object_type").isin(*KINDS)
    complete = (
        F.col("object_id").isNotNull()
        & F.col("sent_dttm").isNotNull()
        & F.col("payload").isNotNull()
    )
    return F.coalesce(known, F.lit(False)) & complete


def quarantine(df: DataFrame) -> DataFrame:
    """Rows the landing drops, with the reason."""
    reason = (
        F.when(F.col("object_type").isNull() & F.col("object_id").isNull(), "unparseable")
        .when(~F.coalesce(F.col("object_type").isin(*KINDS), F.lit(False)), "unknown type")
        .otherwise("missing field")
    )
    return df.filter(~landable()).withColumn("reason", reason)


def route(df: DataFrame) -> dict[str, DataFrame]:
    """One DataFrame per known message type."""
    return {kind: df.filter(F.col("object_type") == kind) for kind in KINDS}


def with_event_date(df: DataFrame) -> DataFrame:
    """Add ``event_date``, the day of the payload's own time; null where it has none.

    Computed once at landing, so that a day's extract prunes partitions instead of parsing
    everything ever landed.
    """
    text = F.lit(None).cast("string")
    for kind in BY_KIND.values():
        own = F.get_json_object("payload", f"$.{kind.event_time}")
        text = F.when(F.col("object_type") == kind.name, own).otherwise(text)
    # A column of its own, since the day reads the text twice and each read would parse the payload.
    return df.withColumn(_TIME, text).withColumn("event_date", event_day(_TIME)).drop(_TIME)


def flatten(
    df: DataFrame,
    kind: Kind,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = ("object_id", "sent_dttm"),
) -> DataFrame:
    """Payload fields as text columns, in one parse. ``fields`` limits which are extracted."""
    names = list(fields) if fields is not None else kind.payload_names
    schema = ", ".join(f"{name} string" for name in names)
    return _parsed(df, F.col("payload"), schema, keep)


def flatten_currencies(df: DataFrame) -> DataFrame:
    return flatten(df, CURRENCIES)


def flatten_transactions(df: DataFrame) -> DataFrame:
    return flatten(df, TRANSACTIONS)
