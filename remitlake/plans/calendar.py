"""Run dates and the days they work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.functions import Day, anchor_of, day_lit


def run_calendar(bounds: DataFrame) -> DataFrame:
    """One row per run date between ``lo`` and ``hi`` of a one-row DataFrame, with its anchor day."""
    runs = bounds.select(F.explode(F.sequence("lo", "hi")).alias("run_date"))
    anchored = runs.withColumn("anchor_date", anchor_of("run_date"))
    return anchored.withColumn("anchor_text", F.date_format("anchor_date", "yyyy-MM-dd"))


def anchor_dates(spark: SparkSession, lo: Day, hi: Day) -> DataFrame:
    """The calendar for run dates lo..hi, inclusive."""
    return run_calendar(spark.range(1).select(day_lit(lo).alias("lo"), day_lit(hi).alias("hi")))
