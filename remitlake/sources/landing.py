"""The landing table: messages as received, in folders by type, event date and the batch that wrote them.

Type and date come first, so that one day is opened by its own path: the driver lists that day's folders
and not every batch ever written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_text
from remitlake.operators.dedup import first_per_key
from remitlake.operators.parse import landable, with_event_date
from remitlake.schemas import KINDS
from remitlake.scratch import children, delete, exists, matches

# Where a message stood in its topic: the order of arrival. Null for sources without positions.
POSITION = {"partition": "int", "offset": "bigint"}
LANDING_COLUMNS = ["object_id", "object_type", "sent_dttm", "payload", *POSITION, "event_date"]
LANDING_DDL = (
    "object_id string, sent_dttm timestamp, payload string, partition int, offset bigint, "
    "object_type string, event_date date"
)
PARTITIONS = ["object_type", "event_date"]
# Below them, who wrote: streams and batch loads share the folder and never touch each other's files.
OWNER = "batch"
# The folder of messages without a readable event time.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


def position_of(messages: DataFrame) -> list[str]:
    """The position columns that the messages have."""
    return [c for c in POSITION if c in messages.columns]


def as_landed(parsed: DataFrame) -> DataFrame:
    """Parsed messages with the columns of landing."""
    missing = {c: F.lit(None).cast(t) for c, t in POSITION.items() if c not in parsed.columns}
    return with_event_date(parsed).withColumns(missing).select(*LANDING_COLUMNS)


def land(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Batch landing of parsed messages; ``overwrite`` replaces the whole folder.

    The rebalance hint lets adaptive execution cut a dominant day into several files and join small
    ones, so file sizes follow the data.
    """
    rows = as_landed(messages.filter(landable()))
    if mode == "overwrite":
        delete(messages.sparkSession, path)
    elif mode != "append":
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    write_owned(rows.hint("rebalance", *PARTITIONS), path, f"load-{uuid.uuid4().hex}")


def write_owned(rows: DataFrame, path: str, owner: str, by: Sequence[str] = PARTITIONS) -> None:
    """Write rows into folders by ``by`` and the owner; folders that the owner has there are replaced.

    Dynamic overwriting stages each write in a folder of its own, so several writers may work at once.
    """
    owned = rows.withColumn(OWNER, F.lit(owner))
    writer = owned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by, OWNER).parquet(path)


def owner_of(run: str, batch_id: int) -> str:
    return f"{run}-{batch_id}"


def drop_owner(spark: SparkSession, path: str, owner: str, by: Sequence[str] = PARTITIONS) -> int:
    """Delete what an owner wrote in an attempt that failed; returns the number of folders.

    An attempt is repeated only by a query that starts again, so the folders are listed once a start.
    """
    found = matches(spark, "/".join([path, *("*" for _ in by), f"{OWNER}={owner}"]))
    for folder in found:
        delete(spark, folder)
    return len(found)


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the write of a micro-batch, whose session has it switched off.

    The stateful part has run by then or is planned already; the setting is put back for the next batch.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def land_as(rows: DataFrame, path: str, run: str, batch_id: int, dealt: bool = False) -> None:
    """Landing rows of one batch of a run; the same batch again replaces what it wrote.

    Rows are joined into few files per type and day, by their size. ``dealt`` rows are written as they
    are laid out.
    """
    owner = owner_of(run, batch_id)
    if dealt:
        write_owned(rows, path, owner)
        return
    with _adaptive(rows.sparkSession):
        write_owned(rows.hint("rebalance", *PARTITIONS), path, owner)


def read_all(spark: SparkSession, path: str) -> DataFrame:
    """Every landed message, of every type and day: the only read that lists the whole folder."""
    return _read(spark, path, [path] if exists(spark, path) else [])


def _read(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """The given folders of ``path``, with the columns of landing; none give no rows."""
    columns = [c.split()[0] for c in LANDING_DDL.split(", ")]
    if not folders:
        return spark.createDataFrame([], LANDING_DDL).select(*columns)
    reader = spark.read.option("basePath", path).schema(f"{LANDING_DDL}, {OWNER} string")
    return reader.parquet(*folders).select(*columns)


def day_folder(path: str, kind: str, day: Day | None) -> str:
    return f"{path}/object_type={kind}/event_date={UNDATED if day is None else day_text(day)}"


def landed_days(
    spark: SparkSession, path: str, kind: str, lo: Day | None = None, hi: Day | None = None
) -> list[str]:
    """Days that a type has folders for, within lo..hi; one listing of day names."""
    names = [c.partition("=")[2] for c in children(spark, f"{path}/object_type={kind}")]
    first, last = (None if d is None else day_text(d) for d in (lo, hi))
    return sorted(
        d
        for d in names
        if d != UNDATED and (first is None or first <= d) and (last is None or d <= last)
    )


def read_days(
    spark: SparkSession, path: str, kinds: Iterable[str], days: Iterable[Day | None]
) -> DataFrame:
    """The given types and event days (None: without one), opened by their own paths."""
    every = list(days)
    folders = [day_folder(path, kind, day) for kind in kinds for day in every]
    return _read(spark, path, [f for f in folders if exists(spark, f)])


def read_landing(spark: SparkSession, path: str, kind: str, day: Day | None = None) -> DataFrame:
    """One message type, one event day or all; nothing else is listed or read."""
    if day is not None:
        return read_days(spark, path, [kind], [day])
    folder = f"{path}/object_type={kind}"
    return _read(spark, path, [folder] if exists(spark, folder) else [])


def read_landing_range(
    spark: SparkSession, path: str, kind: str, lo: Day, hi: Day
) -> DataFrame:
    """One message type for the event days lo..hi, inclusive."""
    return read_days(spark, path, [kind], landed_days(spark, path, kind, lo, hi))


def read_undated(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Landed messages whose payload has no readable event time; no daily extract sees them."""
    return read_days(spark, path, [kind], [None])


def compact_landing(spark: SparkSession, path: str, lo: Day, hi: Day) -> int:
    """Join the files that many batches left for the event days lo..hi; returns parts replaced.

    Meant for days that the stream is past; the daily run calls it for them. The rows of a type are
    written under an owner of their own and then the parts they came from are deleted; a reader in
    between, or after a failure in between, sees them twice and the staging de-duplication drops the
    repeats. Only folders of those days are listed, and a part that arrives meanwhile is neither copied
    nor deleted.
    """
    replaced = 0
    for kind in KINDS:
        days = [day_folder(path, kind, d) for d in landed_days(spark, path, kind, lo, hi)]
        parts = {day: children(spark, day) for day in days}
        folders = [f"{day}/{p}" for day, found in parts.items() if len(found) > 1 for p in found]
        if not folders:
            continue
        merged = _read(spark, path, folders).hint("rebalance", *PARTITIONS)
        write_owned(merged, path, f"joined-{uuid.uuid4().hex}")
        for folder in folders:
            delete(spark, folder)
        replaced += len(folders)
    return replaced


def landed_keys(
    spark: SparkSession, path: str, kinds: Iterable[str], days: Iterable[Day | None]
) -> DataFrame:
    """object_type, object_id and event_date of what landed on the given days; no payload is read."""
    return read_days(spark, path, kinds, days).select("object_type", "object_id", "event_date")


def not_landed(rows: DataFrame, path: str) -> DataFrame:
    """The rows of a batch whose id has not landed on their event day, one per id and day.

    Opened are the days that the batch touches, and of those the key columns only. Of rows with one id
    and day the first by position stays, for sources without positions the first sent. Types and days
    are collected: a row for each day of the batch.
    """
    key = ["object_type", "object_id", "event_date"]
    order = [*POSITION, "sent_dttm", "payload"]
    one = first_per_key(rows, key, [F.col(c) for c in order])
    met = rows.select("object_type", "event_date").distinct().collect()
    kinds = sorted({r.object_type for r in met})
    days = sorted({r.event_date for r in met}, key=str)
    held = landed_keys(rows.sparkSession, path, kinds, days).alias("held")
    same = [F.col(f"new.{c}").eqNullSafe(F.col(f"held.{c}")) for c in key]
    return one.alias("new").join(held, same, "left_anti")
