"""The landing stream: parse, drop repeats, land by type and event date."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from remitlake.operators.parse import landable, parse_envelope, quarantine
from remitlake.session import STATE_STORE
from remitlake.sources.jdbc import write_jdbc
from remitlake.scratch import delete, exists
from remitlake.sources.landing import (
    PARTITIONS,
    as_landed,
    drop_owner,
    land_as,
    not_landed,
    owner_of,
    position_of,
    write_owned,
)

KEYS = ["object_type", "object_id"]
DELAY = "5 minutes"
MODES = ("exact", "bounded", "landed")
# The watermark that a late row was judged by.
WATERMARK = "watermark"
# Rows, batch id and run: batch ids begin anew with a new checkpoint, runs are never the same.
BatchWriter = Callable[[DataFrame, int, str], None]


def collapse_repeats(df: DataFrame) -> DataFrame:
    """Drop repeats of a key within each Arrow batch, keeping the first and every later event time.

    A repeat with a later event time than all before it goes on: the first may turn out too late for
    the watermark, and event times move the watermark. Streaming de-duplication shuffles every row by
    key and has no map-side step of its own. Without this a key repeated through the stream would send
    all its rows to one task.
    """

    def first_of_batch(batches):
        # Nested, so that it travels by value and executors need no copy of this package.
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows < 2:
                yield batch
                continue
            rows = batch.select(["object_type", "object_id", "sent_dttm"]).to_pandas()
            key = [rows["object_type"], rows["object_id"]]
            latest = rows["sent_dttm"].groupby(key, dropna=False).cummax()
            before = latest.groupby(key, dropna=False).shift()
            yield batch.filter(pa.array(before.isna() | (rows["sent_dttm"] > before)))

    return df.mapInArrow(first_of_batch, df.schema)


def dedup_stream(
    df: DataFrame, mode: str = "exact", delay: str = DELAY, collapse: bool = False
) -> DataFrame:
    """Keep the first arrival of each (object_type, object_id).

    ``exact`` remembers every key for ever: nothing late is lost and state grows with the number of
    keys. ``bounded`` forgets a key ``delay`` after its event time and drops rows later than that:
    state is bounded, and a key coming back after it was forgotten is passed on again (the staging
    de-duplication removes it). ``landed`` remembers nothing in the stream: each batch is compared with
    what has landed (``not_landed``), so that nothing late is lost and no state grows.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if collapse:
        df = collapse_repeats(df)
    if mode == "exact":
        return df.dropDuplicates(KEYS)
    if mode == "bounded":
        return df.withWatermark("sent_dttm", delay).dropDuplicatesWithinWatermark(KEYS)
    return df


def landing_rows(
    messages: DataFrame, mode: str = "exact", delay: str = DELAY, collapse: bool = False
) -> DataFrame:
    """Raw messages to de-duplicated landing rows.

    Rows that cannot land are filtered before the de-duplication, where they would all share the
    null key. They are counted under the name ``landing`` in the query's progress.
    """
    parsed = parse_envelope(messages, keep=position_of(messages)).observe(
        "landing",
        F.count("*").alias("messages"),
        F.count_if(~landable()).alias("quarantined"),
    )
    unique = dedup_stream(parsed.filter(landable()), mode, delay, collapse)
    return as_landed(unique)


_STARTING = threading.Lock()


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Start a query with RocksDB state unless the session names a store.

    A query copies the settings when it starts, so the session's own are put back at once. Starts
    from several threads wait for each other.
    """
    with _STARTING:
        unset = [key for key in STATE_STORE if spark.conf.get(key, None) is None]
        for key in unset:
            spark.conf.set(key, STATE_STORE[key])
        try:
            yield
        finally:
            for key in unset:
                spark.conf.unset(key)


def _start(
    spark: SparkSession, writer: DataStreamWriter, available_now: bool, every: str | None
) -> StreamingQuery:
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    with _state_on_disk(spark):
        return writer.start()


class _Attempts:
    """Removes what a failed attempt of a batch left, which a repeated one may not overwrite.

    A batch is repeated only after a restart, so only the first batch of a start has to look.
    """

    def __init__(self, by: Sequence[str] = PARTITIONS):
        self._by, self._last = by, ""

    def clear(self, spark: SparkSession, owner: str, *paths: str) -> None:
        if self._last in ("", owner):
            for path in paths:
                drop_owner(spark, path, owner, self._by)
        self._last = owner


def run_landing(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "exact",
    delay: str = DELAY,
    collapse: bool = False,
    available_now: bool = False,
    every: str | None = None,
    files_per_batch: int | None = None,
    late_path: str | None = None,
) -> StreamingQuery:
    """Land into one partitioned Parquet folder, each message exactly once across restarts.

    A batch that is written again replaces itself. ``land`` may add to the same folder. Each batch is
    written as few files per type and day, cut by size; ``files_per_batch`` repartitions by message id
    instead.

    Mode ``landed`` keeps no state: an id lands once per event day, and each batch reads the ids of the
    days that it touches. With ``late_path``, rows whose sending time is ``delay`` or more behind the
    largest of the batches before do not land but are kept there, repeats included, with the watermark
    that they missed (``dropped_late`` counts what mode ``bounded`` drops).
    """
    if late_path and mode != "landed":
        raise ValueError("late_path needs mode 'landed'")
    rows = landing_rows(messages, mode, delay, collapse)
    if files_per_batch:
        rows = rows.repartition(files_per_batch, "object_id")
    attempts = _Attempts()

    def write(df: DataFrame, batch_id: int, run: str) -> None:
        attempts.clear(df.sparkSession, owner_of(run, batch_id), path, *filter(None, [late_path]))
        if mode != "landed":
            land_as(df, path, run, batch_id, dealt=bool(files_per_batch))
            return
        df.persist()
        try:
            on_time = df
            if late_path:
                on_time = _set_late_aside(df, f"{checkpoint}/event_time", late_path, run, batch_id, delay)
            land_as(not_landed(on_time, path), path, run, batch_id)
        finally:
            df.unpersist()

    return _start_batches(rows, write, checkpoint, available_now, every)


def _set_late_aside(
    df: DataFrame, clock: str, late_path: str, run: str, batch_id: int, delay: str
) -> DataFrame:
    """Keep the late rows of a batch in ``late_path``; returns the others.

    ``clock`` holds the largest sending time up to each batch, so that a batch that is repeated after a
    restart is judged by the same watermark. The last two are kept.
    """
    spark = df.sparkSession
    before, now = f"{clock}/batch={batch_id - 1}", f"{clock}/batch={batch_id}"
    known = spark.read.schema("seen timestamp").parquet(before) if exists(spark, before) else None
    seen = df.agg(F.max("sent_dttm").alias("seen"))
    seen = seen if known is None else seen.union(known).agg(F.max("seen").alias("seen"))
    seen.coalesce(1).write.mode("overwrite").parquet(now)
    delete(spark, f"{clock}/batch={batch_id - 2}")
    if known is None:
        return df
    watermark = F.lit(known.head().seen) - F.expr(f"INTERVAL {delay}")
    late = F.coalesce(F.col("sent_dttm") <= watermark, F.lit(False))
    write_owned(df.filter(late).withColumn(WATERMARK, watermark), late_path, owner_of(run, batch_id))
    return df.filter(~late)


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the watermark of mode ``bounded`` dropped, in the batches that Spark still reports."""
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return sum(o["numRowsDroppedByWatermark"] for o in operators)


def _start_batches(
    rows: DataFrame, write: BatchWriter, checkpoint: str, available_now: bool, every: str | None
) -> StreamingQuery:
    """Write each micro-batch under the query's id, which a checkpoint keeps across restarts."""
    named, run = threading.Event(), []

    def batch(df: DataFrame, batch_id: int) -> None:
        named.wait()
        write(df, batch_id, run[0])

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    query = _start(rows.sparkSession, writer, available_now, every)
    run.append(str(query.id))
    named.set()
    return query


def run_quarantine(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the messages the landing drops, with their raw text. A query of its own: stateless."""
    raw = messages.select(F.col("value").cast("string").alias("value"))
    writer = (
        quarantine(parse_envelope(raw, keep=["value"]))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _start(messages.sparkSession, writer, available_now, every)


def folder_writer(path: str) -> BatchWriter:
    """A batch writer that is safe to repeat: each batch of a run owns a folder per day and replaces it."""
    attempts = _Attempts(["event_date"])

    def write(df: DataFrame, batch_id: int, run: str) -> None:
        owner = owner_of(run, batch_id)
        attempts.clear(df.sparkSession, owner, path)
        write_owned(df, path, owner, ["event_date"])

    return write


def jdbc_writer(url: str, table: str, props: Mapping[str, str], connections: int = 16) -> BatchWriter:
    """A batch writer that appends the message columns to a database table."""

    def write(df: DataFrame, batch_id: int, run: str) -> None:
        rows = df.select("object_id", "object_type", "sent_dttm", "payload")
        write_jdbc(rows, url, table, props, connections)

    return write


def land_batch(
    df: DataFrame, batch_id: int, writers: Mapping[str, BatchWriter], run: str = "manual"
) -> None:
    """Write one micro-batch to a target per message type; it is computed once and then released."""
    df.persist()
    try:
        for kind, write in writers.items():
            write(df.filter(F.col("object_type") == kind), batch_id, run)
    finally:
        df.unpersist()


def run_fan_out(
    messages: DataFrame,
    writers: Mapping[str, BatchWriter],
    checkpoint: str,
    mode: str = "exact",
    delay: str = DELAY,
    collapse: bool = False,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Land into separate targets, such as two database tables.

    A batch may be written again after a failure: use writers that replace by batch id, or rely on
    the staging de-duplication.
    """
    rows = landing_rows(messages, mode, delay, collapse)

    def write(df: DataFrame, batch_id: int, run: str) -> None:
        land_batch(df, batch_id, writers, run)

    return _start_batches(rows, write, checkpoint, available_now, every)
