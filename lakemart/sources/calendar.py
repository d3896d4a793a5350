"""Generated calendar and small constant lookups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import is_holiday, is_public_holiday, is_weekend, iso_week, iso_weekday, season, week_start

# The first and last day of the reference calendar.
REFERENCE_START = "2024-01-01"
REFERENCE_END = "2025-02-02"


def calendar(spark: SparkSession, start: str = REFERENCE_START, end: str = REFERENCE_END,
             holidays: Iterable[str] | None = None) -> DataFrame:
    """One row per day in [start, end]: date, week start (Monday), year, month,
    ISO week, ISO weekday (1 = Monday), weekend, holiday, season.

    ``holidays``: dates of a list, by default the public holidays by rule. Built
    from ``spark.range``, so the rows are generated on the executors.
    """
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    if n_days <= 0:
        raise ValueError(f"empty calendar range {start}..{end}")
    days = spark.range(0, n_days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))
    return describe_days(days, is_public_holiday("date") if holidays is None else is_holiday("date", holidays))


def calendar_of(dates: DataFrame, column: str = "date") -> DataFrame:
    """The calendar of whole weeks from the first to the last of the dates:
    no date of the data is outside it. No dates give no rows."""
    bounds = dates.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    sunday = F.date_add(week_start("_hi"), 6)
    days = bounds.filter(F.col("_lo").isNotNull()).select(F.explode(F.sequence(week_start("_lo"), sunday)).alias("date"))
    return describe_days(days, is_public_holiday("date"))


def describe_days(days: DataFrame, holiday: Column) -> DataFrame:
    """Calendar columns of a table of days (``date``)."""
    return days.select(
        "date",
        week_start("date").alias("week_start"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        iso_week("date").alias("iso_week"),
        iso_weekday("date").alias("weekday"),
        is_weekend("date").alias("is_weekend"),
        holiday.alias("is_holiday"),
        season(F.month("date")).alias("season"),
    )


def lookup(spark: SparkSession, mapping: Mapping, key: str, value: str | list[str]) -> DataFrame:
    """A small constant table from a Python mapping (values may be tuples).

    Size is bounded by the mapping in code, so it is safe to broadcast.
    """
    names = [value] if isinstance(value, str) else list(value)
    rows = []
    for k, v in mapping.items():
        vals = v if isinstance(v, tuple) else (v,)
        rows.append((k, *vals))
    return spark.createDataFrame(rows, schema=[key, *names])
