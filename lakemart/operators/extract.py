"""The source extract: yearly catch lines to the course's landing, vessel and
sea-condition files, expressed as Spark jobs.

* ``select_catch``   code clean-up, species/area selection, date range, week
* ``sample_lines``   first 8 valid and first invalid line per week x species x area
* ``landing_rows``   the landings file layout
* ``vessel_master``  newest non-NULL value per vessel attribute, width from the
                     register, length groups, hp to kW
* ``daily_sea``      hourly API arrays to daily means per area
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.functions import (
    concat_key,
    hp_to_kw,
    kmh_to_ms,
    quote_name,
    strip,
    strip_dot0,
    to_date_dayfirst,
    to_number,
    try_number,
    vessel_group,
    week_start,
    zfill_code,
)

# Column names of the catch-line source used by the extract.
DOC = "Dokumentnummer"
SALES_ORG = "Salgslag (kode)"
LINE = "Linjenummer"
DATE = "Landingsdato"
VESSEL = "Fartøy ID"
SPECIES = "Art FAO (kode)"
SPECIES_NAME = "Art FAO"
AREA = "Hovedområde (kode)"
AREA_NAME = "Hovedområde"
GEAR = "Redskap (kode)"
WEIGHT = "Rundvekt"
CATCH_COLUMNS = (
    "Dokumentnummer", "Salgslag (kode)", "Linjenummer", "Landingsdato", "Fartøy ID",
    "Registreringsmerke (seddel)", "Fartøynavn", "Fartøytype", "Fartøykommune", "Fartøynasjonalitet",
    "Største lengde", "Lengdegruppe", "Bruttotonnasje 1969", "Bruttotonnasje annen", "Byggeår",
    "Motorkraft", "Art FAO (kode)", "Art FAO", "Hovedområde (kode)", "Hovedområde", "Redskap (kode)",
    "Rundvekt",
)
GRAIN = ("week_start", SPECIES, AREA)
N_VALID = 8
N_INVALID = 1


def clean_codes(lines: DataFrame) -> DataFrame:
    """Trimmed species code; area code without a trailing ``.0``, padded to two
    characters (never cut)."""
    return (lines.withColumn(SPECIES, strip(quote_name(SPECIES)))
            .withColumn(AREA, zfill_code(strip_dot0(quote_name(AREA)), 2)))


def filter_codes(df: DataFrame, species: Iterable[str], areas: Iterable[str]) -> DataFrame:
    """Rows whose species and area codes are in the selected sets."""
    return df.filter(F.col(f"`{SPECIES}`").isin(sorted(set(species)))
                     & F.col(f"`{AREA}`").isin(sorted(set(areas))))


def filter_dates(df: DataFrame, start: str, end: str) -> DataFrame:
    """Day-first landing date parsed; rows within [start, end] (inclusive)."""
    x = df.withColumn("landing_date", to_date_dayfirst(quote_name(DATE)))
    return x.filter(F.col("landing_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def select_catch(lines: DataFrame, species: Iterable[str], areas: Iterable[str],
                 start: str, end: str) -> DataFrame:
    """Clean codes, keep selected codes and dates, add the Monday of the week
    and the weight parsed as a Norwegian number."""
    x = filter_dates(filter_codes(clean_codes(lines), species, areas), start, end)
    return (x.withColumn("week_start", week_start("landing_date"))
            .withColumn("weight_num", to_number(quote_name(WEIGHT))))


def require_rows(selected: DataFrame) -> DataFrame:
    """``selected``, or an error when no line matches (a wrong code or date range
    shall not give an empty file)."""
    if selected.isEmpty():
        raise ValueError("no catch lines match the selected codes and dates")
    return selected


def valid_line() -> Column:
    """Vessel id present and not blank, weight > 0 (NULL counts as invalid)."""
    v = quote_name(VESSEL)
    return F.coalesce(v.isNotNull() & (strip(v) != "") & (F.col("weight_num") > 0), F.lit(False))


def line_order(df: DataFrame) -> list[Column]:
    """Date, document, line (as text, like the source), then the rest of the
    row as a tie-break so the sample is the same on every run."""
    first = [F.col("landing_date"), quote_name(DOC), quote_name(LINE)]
    skip = {DOC, LINE, "landing_date", "week_start", SPECIES, AREA, "weight_num", "_valid"}
    rest = [quote_name(c).asc_nulls_last() for c in df.columns if c not in skip]
    return [c.asc_nulls_last() for c in first] + rest


def sample_lines(selected: DataFrame, n_valid: int = N_VALID, n_invalid: int = N_INVALID) -> DataFrame:
    """First ``n_valid`` valid and first ``n_invalid`` invalid lines per
    week x species x area in one window (partitioned by grain and validity).

    The rank filter carries a literal bound, so Spark plans a partial
    WindowGroupLimit before the shuffle: each map task forwards at most
    ``n_valid`` rows per group, however large a group is.
    """
    tagged = selected.withColumn("_valid", valid_line())
    w = Window.partitionBy(*[F.col(f"`{c}`") for c in GRAIN], F.col("_valid")).orderBy(*line_order(tagged))
    ranked = tagged.withColumn("_rn", F.row_number().over(w))
    bound = max(n_valid, n_invalid)
    keep = (F.col("_rn") <= bound) & F.when(F.col("_valid"), F.col("_rn") <= n_valid).otherwise(F.col("_rn") <= n_invalid)
    return ranked.filter(keep).drop("_rn")


def landing_rows(sample: DataFrame, species_names: Mapping[str, str], in_order: bool = False) -> DataFrame:
    """The landings file layout: note id ``sales-org-document-line`` (missing
    parts as ``X``), day-first date text, species name falling back to the
    lookup name, weight as parsed number.

    ``in_order``: rows by week, species, area, date, document and line. They are
    sorted after the join, since Catalyst drops a sort below one, and before
    dates become text."""
    names = sample.sparkSession.createDataFrame(list(species_names.items()), ["_code", "_lookup_name"])
    joined = sample.join(F.broadcast(names), quote_name(SPECIES) == F.col("_code"), "left")
    if in_order:
        joined = joined.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in (*GRAIN, "landing_date", DOC, LINE)])
    return joined.select(
        concat_key(quote_name(SALES_ORG), quote_name(DOC), quote_name(LINE)).alias("Seddelnummer"),
        F.date_format("landing_date", "dd.MM.yyyy").alias("Landingsdato"),
        quote_name(VESSEL).alias("Fartøy ID"),
        quote_name(SPECIES).alias("Art FAO (kode)"),
        F.coalesce(quote_name(SPECIES_NAME), F.col("_lookup_name")).alias("Art FAO (navn)"),
        quote_name(AREA).alias("Fangstområde (kode)"),
        quote_name(AREA_NAME).alias("Fangstområde (navn)"),
        quote_name(GEAR).alias("Redskap (kode)"),
        F.col("weight_num").alias("Rundvekt (kg)"),
    )


def latest_non_null(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, each column's value from the newest row where it is not NULL.

    ``max_by`` with an ordering that is NULL when the value is NULL skips
    those rows; it is a declarative aggregate, so Spark combines it map-side
    and a key with very many rows is never gathered in one place.
    """
    aggs = []
    for c in columns:
        # The value itself breaks ties on the order columns: same result on every run.
        ordering = F.struct(*[F.col(o) for o in order], quote_name(c).alias("_v"))
        aggs.append(F.max_by(quote_name(c), F.when(quote_name(c).isNotNull(), ordering)).alias(c))
    return df.groupBy(key).agg(*aggs)


def width_by_vessel(register: DataFrame, key: str = "vessel_id", width: str = "width",
                    year: str = "register_year") -> DataFrame:
    """First non-NULL width per vessel, newest register year first."""
    return (register.withColumn(width, try_number(F.col(width)))
            .groupBy(key).agg(F.max_by(width, F.when(F.col(width).isNotNull(), F.col(year))).alias("width_m")))


def vessel_master(lines: DataFrame, widths: DataFrame) -> DataFrame:
    """One row per vessel in the vessel file layout."""
    attrs = [c for c in ("Registreringsmerke (seddel)", "Fartøynavn", "Fartøytype", "Fartøykommune",
                         "Fartøynasjonalitet", "Største lengde", "Lengdegruppe", "Bruttotonnasje 1969",
                         "Bruttotonnasje annen", "Byggeår", "Motorkraft")]
    source = (lines.filter(quote_name(VESSEL).isNotNull() & (strip(quote_name(VESSEL)) != ""))
              .withColumn("vessel_id", quote_name(VESSEL).cast("string")))
    latest = latest_non_null(source, "vessel_id", attrs, ["landing_date", DOC, LINE])
    merged = latest.join(widths, "vessel_id", "left")
    length = to_number(quote_name("Største lengde"))
    tonnage = F.coalesce(to_number(quote_name("Bruttotonnasje 1969")), to_number(quote_name("Bruttotonnasje annen")))
    return merged.select(
        F.col("vessel_id").alias("Fartøy ID"),
        quote_name("Registreringsmerke (seddel)").alias("Registreringsmerke"),
        quote_name("Fartøynavn").alias("Fartøynavn"),
        quote_name("Fartøytype").alias("Fartøytype"),
        vessel_group(length).alias("Fartøygruppe"),
        length.alias("Lengde (meter)"),
        quote_name("Lengdegruppe").alias("Lengdegruppe"),
        F.col("width_m").alias("Bredde (meter)"),
        tonnage.alias("Bruttotonnasje"),
        to_number(quote_name("Byggeår")).alias("Byggeår"),
        hp_to_kw(to_number(quote_name("Motorkraft"))).alias("Motorkraft (kW)"),
        quote_name("Fartøykommune").alias("Hjemkommune"),
        quote_name("Fartøynasjonalitet").alias("Nasjonalitet"),
    )


def round_mean(c: Column | str, places: int, divisor: float | None = None, in_scale: int = 9) -> Column:
    """Mean rounded half up on its decimal value (NULL when there are no values).

    Inputs count with ``in_scale`` places, as in ``decimal_sum``. The rounding is
    one integer division, ``(2 * unit * |sum| + count) div (2 * count)``, so no
    quotient is rounded twice. ``divisor`` (e.g. 3.6 for km/h to m/s, at most two
    places) divides the mean before it is rounded."""
    col = F.col(c) if isinstance(c, str) else c
    unit, scaled = 10 ** places, 1 if divisor is None else round(divisor * 100)
    total = F.sum(col.cast(f"decimal(29,{in_scale})")).cast(f"decimal(32,{in_scale})") * F.lit(10 ** in_scale if divisor is None else 10 ** in_scale * 100).cast("decimal(12,0)")
    whole = total.cast("decimal(32,0)")
    count = F.count(col).cast("decimal(18,0)") * F.lit(10 ** in_scale * scaled).cast("decimal(14,0)")
    twice = F.lit(2).cast("decimal(1,0)")
    up = F.call_function("div", F.abs(whole) * F.lit(2 * unit).cast("decimal(5,0)") + count, F.nullif(twice * count, F.lit(0)))
    return F.when(F.count(col) > 0, F.signum(whole) * up.cast("double") / F.lit(float(unit)))


def daily_sea(hourly: DataFrame, keys: Sequence[str] = ("area_code",)) -> DataFrame:
    """Hourly readings (``time`` text, temperature, wave height, current in
    km/h) to daily means: temperature and waves at 2 decimals, current in m/s
    at 3 decimals; a day with no readings of a value keeps NULL."""
    rows = hourly.withColumn("date", F.to_date(F.try_to_timestamp(F.col("time"))))
    return rows.groupBy(*keys, "date").agg(
        round_mean("sea_surface_temperature", 2).alias("sea_temp_c"),
        round_mean("wave_height", 2).alias("wave_height_m"),
        round_mean("ocean_current_velocity", 3, divisor=3.6).alias("current_speed_ms"),
    )


def kmh_to_ms_mean(c: str) -> Column:
    """Plain (unrounded) daily mean in m/s."""
    return kmh_to_ms(F.avg(c))
