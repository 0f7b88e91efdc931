"""Payment messages made from the ``events`` table, so that every job can run on given data.

Three consecutive events share a message id, which gives repeats and status changes. With ``dirty``
some messages are damaged in ways the landing or the typing must catch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import event_day
from remitlake.operators.parse import landable, parse_envelope, with_event_date
from remitlake.schemas import CURRENCY, Kind

EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)

_MAPPING = {
    "event_id": "event_id",
    "object_id": "concat('00000000-0000-5000-8000-', lpad(cast(event_id div 3 as string), 12, '0'))",
    "object_type": "if(event_type in ('signup', 'error'), 'CURRENCY', 'TRANSACTION')",
    "sent_dttm": "cast(ts as timestamp)",
    "account_number_from": "user_id - 5",
    "account_number_to": "cast(k - 2 as bigint)",
    "currency_code": "cast(410 + 10 * (user_id % 7) as int)",
    "currency_code_with": "410 + 10 * (k % 7)",
    "currency_with_div": "cast(0.5 + (k % 100) / 100.0 as decimal(8,2))",
    "status": "case event_type when 'view' then 'queued' when 'click' then 'in_progress' "
    "else 'done' end",
    "amount": "cast(round(value * 100) as bigint)",
    "country": "case user_id % 3 when 0 then 'canada' when 1 then 'usa' else 'russia' end",
    "transaction_type": "if(user_id % 2 = 0, 'sbp_outgoing', 'c2a_incoming')",
    "dt": "date_trunc('SECOND', cast(ts as timestamp))",
    "k": "k",
}


def _position() -> list[Column]:
    return [
        (F.col("event_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    ]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1000) -> DataFrame:
    """The same table as a stream. The glob matches a single file as well as a folder."""
    reader = spark.readStream.schema(EVENTS_DDL).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{sf_dir}/events.parquet*")


def feed(events: DataFrame) -> DataFrame:
    """Typed columns of both message kinds, a row per event."""
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    keyed = events.select("event_id", "ts", "user_id", "event_type", "value", k)
    return keyed.select(*[F.expr(sql).alias(name) for name, sql in _MAPPING.items()])


def typed_rows(events: DataFrame, kind: Kind, position: bool = False) -> DataFrame:
    """One kind with its declared columns, repeats included, without the detour over JSON.

    With ``position``, also where the message stands in its topic.
    """
    rows = feed(events).filter(F.col("object_type") == kind.name)
    rows = rows.withColumn("operation_id", F.col("object_id")).withColumn(
        kind.event_time, F.col("dt")
    )
    return rows.withColumn("sent_dttm", F.date_trunc("MILLISECOND", "sent_dttm")).select(
        *kind.names, *(_position() if position else [])
    )


def messages(events: DataFrame, dirty: bool = False) -> DataFrame:
    """Topic rows, all kinds mixed: binary key and value, topic, partition, offset, timestamp."""
    rows = feed(events)
    stamp = F.date_format("dt", "yyyy-MM-dd HH:mm:ss")
    sent = F.date_format("sent_dttm", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    object_type, amount, country = F.col("object_type"), F.col("amount"), F.col("country")
    rate = F.col("currency_with_div")
    k = F.col("k")
    if dirty:
        object_type = F.when(k % 23 == 1, "HEARTBEAT").otherwise(object_type)
        sent = F.when(k % 29 == 2, "yesterday").otherwise(sent)
        stamp = F.when(k % 31 == 3, "n/a").otherwise(stamp)
        amount = F.when(k % 11 == 4, "abc").otherwise(amount.cast("string"))
        country = F.when(k % 13 == 5, F.repeat(F.lit("x"), F.lit(65))).otherwise(country)
        rate = F.when(k % 17 == 6, "99999999.99").otherwise(rate.cast("string"))
    is_rate = F.col("object_type") == CURRENCY
    rate_payload = F.to_json(
        F.struct(
            stamp.alias("date_update"),
            "currency_code",
            "currency_code_with",
            rate.alias("currency_with_div"),
        )
    )
    tx_payload = F.to_json(
        F.struct(
            F.col("object_id").alias("operation_id"),
            "account_number_from",
            "account_number_to",
            "currency_code",
            country.alias("country"),
            "status",
            "transaction_type",
            amount.alias("amount"),
            stamp.alias("transaction_dt"),
        )
    )
    envelope = F.to_json(F.struct("object_id", object_type.alias("object_type"), sent.alias("sent_dttm")))
    # The payload is nested as an object, not as text.
    payload = F.when(is_rate, rate_payload).otherwise(tx_payload)
    value = F.concat(F.rtrim(envelope, F.lit("}")), F.lit(',"payload":'), payload, F.lit("}"))
    if dirty:
        value = F.when(k % 19 == 0, F.concat(F.lit("not json "), "event_id")).otherwise(value)
    return rows.select(
        F.col("object_id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.when(is_rate, "rates").otherwise("payments").alias("topic"),
        *_position(),
        F.col("sent_dttm").alias("timestamp"),
    )


def landed(events: DataFrame, dirty: bool = False, kind: Kind | None = None) -> DataFrame:
    """Landing rows of one kind or both, split after the mixed messages are parsed.

    Making and parsing messages costs far more than reading events, and a file is cut at its row groups
    only: the narrow rows are dealt out first, whatever the files hold. By hash they need no sort, which
    dealing in turn would put before the shuffle.
    """
    dealt = events.hint("rebalance", *events.columns)
    parsed = parse_envelope(messages(dealt, dirty), keep=["partition", "offset"])
    rows = with_event_date(parsed.filter(landable()))
    return rows if kind is None else rows.filter(F.col("object_type") == kind.name)


def day_bounds(events: DataFrame) -> DataFrame:
    """First and last event day, as one row (lo, hi)."""
    day = event_day("ts")
    return events.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
