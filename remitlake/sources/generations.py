"""Day-partitioned tables that readers see change once.

A table is a view over a *generation*: an external table whose partitions point to folders. Every write
goes to a folder of its own. A change of any number of days is a new generation, which takes the folders
of unchanged days from the one before, and one statement lets the view show it. So a reader sees the rows
before or after a change, never some days of each, and a query that has begun reads on in folders that
stay until ``vacuum``.

Only metadata is copied: a partition entry per day and write. One writer changes a table at a time, as the
daily runs do; threads of one driver wait for each other, and a change by another driver is noticed.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_text
from remitlake.scratch import children, delete

# Which write a partition's folder belongs to; a column of the generations, not of the view.
WRITTEN = "written"
_AT_ONCE = 500
_CHANGING: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)


def create(spark: SparkSession, table: str, columns: str, key: str) -> None:
    """Create an empty table of ``columns`` and the date column ``key`` unless it exists."""
    if spark.catalog.tableExists(table):
        return
    first = _new_generation(spark, table, f"{columns}, {key} date", key, [])
    names = [*(c.split()[0] for c in _columns_of(columns)), key]
    spark.sql(f"CREATE VIEW {table} AS SELECT {', '.join(names)} FROM {first}")


def _columns_of(ddl: str) -> list[str]:
    return [c.strip() for c in re.split(r",(?![^()]*\))", ddl)]


def _token() -> str:
    return f"{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def _age(token: str, now: dt.datetime) -> dt.timedelta:
    return now - dt.datetime.strptime(token[:20], "%Y%m%d%H%M%S%f").replace(tzinfo=dt.UTC)


def root(spark: SparkSession, table: str) -> str:
    """The folder of a table's writes, in that of its database."""
    database, _, name = table.rpartition(".")
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"


def _new_generation(
    spark: SparkSession, table: str, columns: str, key: str, parts: Iterable[tuple[str, str]]
) -> str:
    """An external table with the given (day, write) partitions; nobody reads it yet."""
    folder, name = root(spark, table), f"{table}__{_token()}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}, {WRITTEN} string) USING parquet "
        f"PARTITIONED BY ({key}, {WRITTEN}) LOCATION '{folder}/_generation'"
    )
    specs = [
        f"PARTITION ({key} = DATE'{day}', {WRITTEN} = '{write}') LOCATION '{folder}/{write}/{key}={day}'"
        for day, write in sorted(parts)
    ]
    for at in range(0, len(specs), _AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(specs[at : at + _AT_ONCE])}")
    return name


def live(spark: SparkSession, table: str) -> str:
    """The generation that a table shows."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    text = next((r.data_type for r in described if r.col_name == "View Text"), "")
    found = re.search(rf"FROM (\S*{re.escape(table.rpartition('.')[2])}__\w+)$", text)
    if not found:
        raise ValueError(f"{table} was not created as a table of generations")
    return found[1]


def key_of(spark: SparkSession, table: str) -> str:
    """The day column, which is the last one."""
    live(spark, table)
    return spark.table(table).columns[-1]


def _parts(spark: SparkSession, generation: str) -> list[tuple[str, str]]:
    """(day, write) of every partition, from the catalog."""
    rows = spark.sql(f"SHOW PARTITIONS {generation}").collect()
    return [tuple(x.partition("=")[2] for x in row[0].split("/")) for row in rows]


def days_of(spark: SparkSession, table: str) -> list[str]:
    return sorted({day for day, _ in _parts(spark, live(spark, table))})


def _show(spark: SparkSession, table: str, columns: Sequence[str], generation: str) -> None:
    """The one statement by which readers see a change."""
    spark.sql(f"ALTER VIEW {table} AS SELECT {', '.join(columns)} FROM {generation}")


def _change(
    spark: SparkSession, table: str, gone: Iterable[str], added: Iterable[tuple[str, str]]
) -> None:
    """Show a generation without the days ``gone`` and with the partitions ``added``."""
    gone, added = set(gone), list(added)
    with _CHANGING[table]:
        while True:
            before = live(spark, table)
            parts = _parts(spark, before)
            after = [p for p in parts if p[0] not in gone] + added
            if sorted(after) == sorted(parts):
                return
            shown = spark.table(table)
            key = key_of(spark, table)
            ddl = ", ".join(f"{name} {kind}" for name, kind in shown.dtypes)
            new = _new_generation(spark, table, ddl, key, after)
            if live(spark, table) == before:
                _show(spark, table, shown.columns, new)
                return
            # Another driver was first: begin again from what it shows.
            spark.sql(f"DROP TABLE {new}")


@dataclass(frozen=True)
class Write:
    """Rows written beside a table, which does not show them yet."""

    table: str
    key: str
    folder: str
    days: tuple[str, ...]

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows, with the columns of the table."""
        schema = spark.table(self.table).schema
        if not self.days:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.folder).select(*schema.names)


def write_beside(rows: DataFrame, table: str, options: Mapping[str, str] | None = None) -> Write:
    """Write ``rows`` as they are laid out, in one job and cast to the table's types."""
    spark = rows.sparkSession
    key = key_of(spark, table)
    folder = f"{root(spark, table)}/{_token()}"
    typed = rows.select(*(F.col(n).cast(t).alias(n) for n, t in spark.table(table).dtypes))
    typed.write.options(**(options or {})).partitionBy(key).parquet(folder)
    found = [name.partition("=")[2] for name in children(spark, folder)]
    try:
        return Write(table, key, folder, tuple(day_text(d) for d in found))
    except ValueError as e:
        delete(spark, folder)
        raise ValueError(f"rows for {table} have no {key}") from e


def show(
    spark: SparkSession, write: Write, replaced: Iterable[Day] = (), append: bool = False
) -> list[str]:
    """Let readers see a write; returns the days that it fills.

    Replaced are those days and the days ``replaced``, which are gone where no row fills them; with
    ``append`` nothing is.
    """
    gone = set() if append else {*write.days, *map(day_text, replaced)}
    name = write.folder.rpartition("/")[2]
    _change(spark, write.table, gone, [(day, name) for day in write.days])
    return list(write.days)


def forget(spark: SparkSession, write: Write) -> None:
    """Delete a write that is not to be shown."""
    delete(spark, write.folder)


def publish(
    rows: DataFrame,
    table: str,
    replaced: Iterable[Day] = (),
    append: bool = False,
    options: Mapping[str, str] | None = None,
) -> list[str]:
    """``write_beside`` and ``show``."""
    write = write_beside(rows, table, options)
    return show(rows.sparkSession, write, replaced, append)


def discard(spark: SparkSession, table: str, days: Iterable[Day]) -> list[str]:
    """Take the given days out of a table; returns those that it had."""
    wanted = {day_text(d) for d in days}
    found = [d for d in days_of(spark, table) if d in wanted]
    if found:
        _change(spark, table, found, [])
    return found


def vacuum(spark: SparkSession, table: str, older_than: dt.timedelta) -> int:
    """Forget generations that were replaced, and delete writes that none shows any more.

    What is younger than ``older_than`` stays, for queries that have begun on it; returns the number of
    writes deleted. A generation is as old as its successor allows: it counts from its own making.
    """
    now, shown = dt.datetime.now(dt.UTC), live(spark, table).rpartition(".")[2]
    database, _, name = table.rpartition(".")
    used: set[str] = set()
    for found in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect():
        generation = f"{database}.{found.tableName}"
        if found.tableName != shown and _age(found.tableName[len(name) + 2 :], now) > older_than:
            spark.sql(f"DROP TABLE {generation}")
        else:
            used |= {write for _, write in _parts(spark, generation)}
    writes = [w for w in children(spark, root(spark, table)) if w not in used]
    old = [w for w in writes if _age(w, now) > older_than]
    for write in old:
        delete(spark, f"{root(spark, table)}/{write}")
    return len(old)
