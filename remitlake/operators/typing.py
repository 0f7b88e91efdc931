"""Text columns to declared types, and the rows that do not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlake.functions import dated
from remitlake.schemas import Field, Kind

REASON = "reject_reason"


def _typed(field: Field) -> Column:
    value = F.col(field.name).try_cast(field.type)
    if field.type in ("timestamp", "date"):
        value = F.when(dated(F.col(field.name)), value)
    if field.grain:
        value = F.date_trunc(field.grain, value)
    return value


def _fault(field: Field) -> Column:
    """The first rule the text breaks, as ``column: rule``; null when the value fits."""
    text = F.col(field.name)
    fault = F.when(text.isNotNull() & _typed(field).isNull(), f"{field.name}: {field.type}")
    if field.required:
        fault = fault.when(text.isNull(), f"{field.name}: null")
    if field.max_bytes is not None:
        fault = fault.when(
            F.octet_length(text) > field.max_bytes, f"{field.name}: over {field.max_bytes} bytes"
        )
    if field.pattern is not None:
        fault = fault.when(~text.rlike(field.pattern), f"{field.name}: format")
    return fault


def apply_types(df: DataFrame, kind: Kind) -> DataFrame:
    """Declared types; a value that does not fit becomes null."""
    return df.select(*[_typed(f).alias(f.name) for f in kind.fields])


def with_faults(df: DataFrame, kind: Kind) -> DataFrame:
    """Add ``reject_reason``: every broken rule, empty text for a good row."""
    return df.withColumn(REASON, F.concat_ws("; ", *[_fault(f) for f in kind.fields]))


def accepted(judged: DataFrame, kind: Kind) -> DataFrame:
    """Typed rows without a fault."""
    return apply_types(judged.filter(F.col(REASON) == ""), kind)


def rejected(judged: DataFrame, kind: Kind) -> DataFrame:
    """Raw text of the rows with faults, and which."""
    return judged.filter(F.col(REASON) != "").select(*kind.names, REASON)


def split_rejects(df: DataFrame, kind: Kind) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows. Both read ``df``; a job that needs both writes
    ``with_faults`` out once and splits that."""
    judged = with_faults(df, kind)
    return accepted(judged, kind), rejected(judged, kind)
