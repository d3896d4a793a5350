"""Date parsing and calendar parts. All parsing is tolerant: bad text gives NULL
(plain ``to_date`` with a pattern raises under ANSI mode)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_fmt(c: Column | str, fmt: str = "dd.MM.yyyy") -> Column:
    return F.try_to_date(_col(c), fmt)


def to_date_iso(c: Column | str) -> Column:
    return F.try_to_date(_col(c))


def to_date_dayfirst(c: Column | str) -> Column:
    """Day-first text (``15.03.2024``, ``15/03/2024``, ``15-03-2024``, optional time)."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), r"[/-]", ".")
    day = F.regexp_extract(text, r"^(\d{1,2}\.\d{1,2}\.\d{4})(?:[ T]\d{1,2}:\d{2}(?::\d{2})?)?$", 1)
    return F.coalesce(F.try_to_date(F.nullif(day, F.lit("")), "d.M.yyyy"), F.try_to_date(_col(c)))


def to_timestamp_iso(c: Column | str) -> Column:
    return F.try_to_timestamp(_col(c))


def week_start(d: Column | str) -> Column:
    """Monday of the ISO week containing ``d``."""
    return F.date_trunc("week", _col(d)).cast("date")


def date_key(d: Column | str) -> Column:
    """``yyyyMMdd`` as int."""
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def date_text(d: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(_col(d), fmt)


def year_of(d: Column | str) -> Column:
    return F.year(_col(d))


def month_of(d: Column | str) -> Column:
    return F.month(_col(d))


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(_col(d))


def iso_weekday(d: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_col(d)) + 1).cast("int")


def is_weekend(d: Column | str) -> Column:
    return iso_weekday(d) >= 6


def is_holiday(d: Column | str, holidays: Iterable[str]) -> Column:
    days = sorted(set(holidays))
    if not days:
        return F.lit(False)
    return _col(d).isin([F.lit(x).cast("date") for x in days])


# Public holidays at a fixed month and day, and by days from Easter
# Sunday (Maundy Thursday, Good Friday, Easter Monday, Ascension, Whit Monday).
FIXED_DATE_HOLIDAYS = ((1, 1), (5, 1), (5, 17), (12, 25), (12, 26))
EASTER_HOLIDAYS = (-3, -2, 1, 39, 50)


def easter_sunday(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, by the anonymous computus in integer
    column arithmetic (days counted from 22 March)."""
    div = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    y = year.cast("int")
    golden, century, rest = y % 19, div(y, 100), y % 100
    moon = (19 * golden + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30
    weekday = (32 + 2 * (century % 4) + 2 * div(rest, 4) - moon - rest % 4) % 7
    late = div(golden + 11 * moon + 22 * weekday, 451)
    return F.date_add(F.make_date(y, F.lit(3), F.lit(22)), moon + weekday - 7 * late)


def is_public_holiday(d: Column | str) -> Column:
    """Whether a date is a fixed-date or movable public holiday of its year."""
    day = _col(d)
    fixed = F.date_format(day, "MM-dd").isin([f"{m:02d}-{n:02d}" for m, n in FIXED_DATE_HOLIDAYS])
    return fixed | F.date_diff(day, easter_sunday(F.year(day))).isin(*EASTER_HOLIDAYS)


# Season names by month, as in the reference calendar.
SEASON_BY_MONTH = {
    "vinter": (12, 1, 2),
    "vaar": (3, 4, 5),
    "sommer": (6, 7, 8),
    "hoest": (9, 10, 11),
}


def season(month: Column | str) -> Column:
    m = _col(month)
    return (F.when(m.isin(*SEASON_BY_MONTH["vinter"]), "vinter")
            .when(m.isin(*SEASON_BY_MONTH["vaar"]), "vaar")
            .when(m.isin(*SEASON_BY_MONTH["sommer"]), "sommer")
            .otherwise("hoest"))
