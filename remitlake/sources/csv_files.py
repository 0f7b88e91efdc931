"""Per-table, per-day CSV exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, day_text

CORRUPT = "_corrupt_record"
# No header; quotes are doubled inside quoted fields; blanks are data; null is \N, empty text is "".
# In text a line end is written as \n or \r and a backslash as two, so that a line is a row.
_FORMAT = {
    "header": "false",
    "sep": ",",
    "lineSep": "\n",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _one_line(text: Column) -> Column:
    for raw, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def _as_was(text: Column) -> Column:
    """Undo ``_one_line``; what stands between written backslashes can only be line ends."""

    def lines(part: Column) -> Column:
        part = F.replace(part, F.lit("\\n"), F.lit("\n"))
        return F.replace(part, F.lit("\\r"), F.lit("\r"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), lines), "\\")


def _texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """``change`` on every text column but the corrupt lines."""
    names = [n for n, kind in df.dtypes if kind == "string" and n != CORRUPT]
    return df.withColumns({n: change(F.col(n)) for n in names}) if names else df


def csv_path(directory: str, table: str, day: Day) -> str:
    return f"{directory.rstrip('/')}/dump_{table}.{day_text(day)}.csv"


def export_csv(
    df: DataFrame, directory: str, table: str, day: Day, max_rows_per_file: int = 5_000_000
) -> str:
    """Write a folder of CSV files in place of the previous export; returns its path."""
    path = csv_path(directory, table, day)
    writer = _texts(df, _one_line).write.mode("overwrite").options(**_FORMAT)
    writer.option("maxRecordsPerFile", max_rows_per_file).csv(path)
    return path


def load_csv(spark: SparkSession, path: str, schema: str, foreign: bool = False) -> DataFrame:
    """Read with a declared schema; a line that does not fit keeps its text in ``_corrupt_record``.

    Exports of this library have a row a line, so large files are cut among tasks. Files from elsewhere
    (``foreign``) may have line breaks in quotes and backslashes that mean nothing: there a file is the
    unit of work.
    """
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").options(
        **_FORMAT, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    if foreign:
        reader = reader.option("multiLine", "true")
    # As a generator, so that whole lines are parsed whatever columns a query uses: which lines are
    # corrupt would otherwise depend on the columns pruned.
    rows = reader.csv(path).select(F.inline(F.array(F.struct("*"))))
    return rows if foreign else _texts(rows, _as_was)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed lines, and the text of the others."""
    return (
        df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT),
        df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT),
    )
