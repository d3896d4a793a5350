"""Number parsing, unit conversion, decimal sums and forecast arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Text without any white space at its ends (not blanks only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def to_number(c: Column | str) -> Column:
    """Norwegian number text: no-break spaces and spaces dropped, decimal comma
    to point; NULL when the rest is not a number."""
    text = F.replace(F.replace(F.replace(_col(c).cast("string"), F.lit("\u00a0"), F.lit("")),
                               F.lit(" "), F.lit("")), F.lit(","), F.lit("."))
    return F.nullif(text, F.lit("")).try_cast("double")


def try_number(c: Column | str) -> Column:
    """Plain text to double, NULL when not a number."""
    return strip(_col(c).cast("string")).try_cast("double")


def hp_to_kw(c: Column | str) -> Column:
    return _col(c) / F.lit(1.36)


def kmh_to_ms(c: Column | str) -> Column:
    return _col(c) / F.lit(3.6)


def kg_to_tonnes(c: Column | str) -> Column:
    return _col(c) / F.lit(1000.0)


def round_keep_null(c: Column | str, places: int) -> Column:
    return F.round(_col(c), places)


def decimal_sum(c: Column | str, scale: int = 9) -> Column:
    """Sum in DECIMAL(38, scale): independent of the order of rows, so equal on
    any cluster layout. Nine places are more than a double holds from 10 million
    on; only digits beyond them are rounded, value by value."""
    return F.sum(_col(c).cast(f"decimal(38,{scale})")).cast("double")


def decimal_mean(c: Column | str, scale: int = 9) -> Column:
    """Mean of the non-NULL values by ``decimal_sum`` (NULL if there are none)."""
    return decimal_sum(c, scale) / F.nullif(F.count(_col(c)), F.lit(0)).cast("double")


def _cycle(week: Column | str) -> Column:
    return F.lit(2 * math.pi) * _col(week) / F.lit(52.0)


def week_sin(week: Column | str) -> Column:
    return F.sin(_cycle(week))


def week_cos(week: Column | str) -> Column:
    return F.cos(_cycle(week))


def abs_error(actual: Column | str, predicted: Column | str) -> Column:
    return F.abs(_col(actual) - _col(predicted))


def pct_deviation(predicted: Column | str, actual: Column | str) -> Column:
    """(predicted - actual) / actual * 100, NULL when actual is 0."""
    return (_col(predicted) - _col(actual)) / F.nullif(_col(actual), F.lit(0.0)) * F.lit(100.0)
