"""Silver: typed, cleaned, deduplicated tables.

Deduplication always picks a row by a total order, so the result does not
depend on partitioning or task timing. The reference keeps "any" row; the
order used here is stated per table. ``row_number() = 1`` is planned by
Spark as a partial WindowGroupLimit before the shuffle, so a key holding a
large share of rows is cut down on the map side and never lands whole in one
task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.functions import lpad_code, to_date_fmt, to_date_iso, variant_field

# Raw source field names of the four sources, with the snake
# case names and types of the typed Silver columns.
LANDING_FIELDS = (
    ("Seddelnummer", "string", "note_id"),
    ("Landingsdato", "string", "landing_date"),
    ("Fartøy ID", "string", "vessel_id"),
    ("Art FAO (kode)", "string", "species_code"),
    ("Art FAO (navn)", "string", "species_name"),
    ("Fangstområde (kode)", "string", "area_code"),
    ("Fangstområde (navn)", "string", "area_name"),
    ("Redskap (kode)", "string", "gear_code"),
    ("Rundvekt (kg)", "double", "weight_kg"),
)
VESSEL_FIELDS = (
    ("Fartøy ID", "string", "vessel_id"),
    ("Registreringsmerke", "string", "registration"),
    ("Fartøynavn", "string", "vessel_name"),
    ("Fartøytype", "string", "vessel_type"),
    ("Fartøygruppe", "string", "vessel_group"),
    ("Lengde (meter)", "double", "length_m"),
    ("Lengdegruppe", "string", "length_group"),
    ("Bredde (meter)", "double", "width_m"),
    ("Bruttotonnasje", "double", "gross_tonnage"),
    ("Byggeår", "double", "build_year"),
    ("Motorkraft (kW)", "double", "power_kw"),
    ("Hjemkommune", "string", "home_municipality"),
    ("Nasjonalitet", "string", "nationality"),
)
SEA_FIELDS = (
    ("dato", "string", "date"),
    ("fangstomrade_kode", "string", "area_code"),
    ("fangstomrade_navn", "string", "area_name"),
    ("havtemperatur_c", "double", "sea_temp_c"),
    ("bolgehoyde_m", "double", "wave_height_m"),
    ("stromhastighet_ms", "double", "current_speed_ms"),
)
CALENDAR_FIELDS = (
    ("dato", "string", "date"),
    ("uke_start", "string", "week_start"),
    ("aar", "int", "year"),
    ("maaned", "int", "month"),
    ("ukenummer", "int", "iso_week"),
    ("ukedag", "int", "weekday"),
    ("er_helg", "boolean", "is_weekend"),
    ("er_helligdag", "boolean", "is_holiday"),
    ("sesong", "string", "season"),
)

LANDING_KEYS = ("landing_date", "vessel_id", "species_code", "area_code")


def variant_select(bronze: DataFrame, fields: Sequence[tuple[str, str, str]],
                   payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from a VARIANT payload: ``(source name or $-path, type, alias)``.

    Missing fields and failed casts give NULL.
    """
    cols = [variant_field(payload, name, type_).alias(alias) for name, type_, alias in fields]
    return bronze.select(*cols, *keep)


def parse_landings(bronze: DataFrame, date_format: str = "dd.MM.yyyy") -> DataFrame:
    typed = variant_select(bronze, LANDING_FIELDS, keep=["_ingest_ts"])
    return typed.withColumn("landing_date", to_date_fmt("landing_date", date_format))


def parse_vessels(bronze: DataFrame) -> DataFrame:
    """Build year is read as double, then cast: ``1999.0`` keeps its value."""
    typed = variant_select(bronze, VESSEL_FIELDS)
    return typed.withColumn("build_year", F.col("build_year").cast("int"))


def parse_sea(bronze: DataFrame) -> DataFrame:
    typed = variant_select(bronze, SEA_FIELDS)
    return typed.withColumn("date", to_date_iso("date"))


def parse_calendar(bronze: DataFrame) -> DataFrame:
    typed = variant_select(bronze, CALENDAR_FIELDS)
    return (typed.withColumn("date", to_date_iso("date"))
            .withColumn("week_start", to_date_iso("week_start")))


def row_order(df: DataFrame, first: Sequence[Column] = (), exclude: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every other column ascending, NULLs last: a total
    order up to identical rows (which are interchangeable)."""
    skip = set(exclude)
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in skip]
    return [*first, *rest]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
                  helper: str = "_rn") -> DataFrame:
    """One row per key: the first by ``order`` (default: all other columns)."""
    order = list(order) if order is not None else row_order(df, exclude=keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(helper, F.row_number().over(w)).filter(F.col(helper) == 1).drop(helper)


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    helper: str = "_rn") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(helper, F.row_number().over(w)).filter(F.col(helper) <= n).drop(helper)


def valid_landing(weight: str = "weight_kg", keys: Sequence[str] = LANDING_KEYS) -> Column:
    """The quality rule as one predicate (area code checked after padding)."""
    cond = F.col(weight) > 0
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return F.coalesce(cond, F.lit(False))


def tag_valid(df: DataFrame, predicate: Column | None = None, name: str = "is_valid") -> DataFrame:
    """Adds the NULL-safe validity flag; ``filter(flag)`` and ``filter(~flag)``
    are then the valid rows and their exact complement."""
    return df.withColumn(name, valid_landing() if predicate is None else F.coalesce(predicate, F.lit(False)))


def split_valid(df: DataFrame, predicate: Column | None = None) -> tuple[DataFrame, DataFrame]:
    tagged = tag_valid(df, predicate, "_valid")
    return (tagged.filter("_valid").drop("_valid"), tagged.filter(~F.col("_valid")).drop("_valid"))


def dedup_notes(parsed: DataFrame, prefer_valid: bool = False) -> DataFrame:
    """One row per note, chosen before the quality filters (as the reference
    does). ``prefer_valid`` ranks rows that pass the rules first."""
    first = [valid_landing().desc()] if prefer_valid else []
    return first_per_key(parsed, ["note_id"], row_order(parsed, first, exclude=["note_id", "_ingest_ts"]))


def clean_landings(parsed: DataFrame, prefer_valid: bool = False) -> DataFrame:
    """Unique note, two-character area code, weight > 0, no missing key.

    Order as in the reference: dedup, pad, filter, dropna.
    """
    return keep_valid(dedup_notes(parsed, prefer_valid))


def keep_valid(notes: DataFrame) -> DataFrame:
    return (notes.withColumn("area_code", lpad_code("area_code", 2))
            .filter(F.col("weight_kg") > 0)
            .dropna(subset=list(LANDING_KEYS)))


def latest_vessels(parsed: DataFrame, year: str = "build_year") -> DataFrame:
    """One row per vessel: highest build year, NULLs last; ties broken by the
    other columns. NULL ids are removed first (same result, no NULL-key hot spot)."""
    rows = parsed.filter(F.col("vessel_id").isNotNull())
    order = row_order(rows, [F.col(year).desc_nulls_last()], exclude=["vessel_id", year])
    return first_per_key(rows, ["vessel_id"], order)


def clean_sea(parsed: DataFrame) -> DataFrame:
    """Two-character area code, one reading per (date, area), no missing key."""
    padded = parsed.withColumn("area_code", lpad_code("area_code", 2))
    keyed = padded.filter(F.col("date").isNotNull() & F.col("area_code").isNotNull())
    return first_per_key(keyed, ["date", "area_code"])


def clean_calendar(parsed: DataFrame) -> DataFrame:
    """One row per date (duplicate rows are identical)."""
    return parsed.dropDuplicates(["date"])


def quality_counts(parsed: DataFrame) -> DataFrame:
    """Rows before cleaning and rows breaking each stated rule, in one pass."""
    padded = lpad_code("area_code", 2)
    return parsed.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.countDistinct("note_id").alias("distinct_notes"),
        F.count_if(F.coalesce(F.col("weight_kg") <= 0, F.lit(True))).alias("bad_weight"),
        F.count_if(F.col("landing_date").isNull()).alias("missing_date"),
        F.count_if(F.col("vessel_id").isNull()).alias("missing_vessel"),
        F.count_if(F.col("species_code").isNull()).alias("missing_species"),
        F.count_if(padded.isNull()).alias("missing_area"),
    )


def clean_landings_observed(parsed: DataFrame, prefer_valid: bool = False) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``clean_landings`` whose counts come from the run that writes it: rows in,
    broken rules, distinct notes and rows out are observed on the way, so they
    cost no second scan and no second dedup. The function returned gives them
    once the DataFrame has been written (it waits until then)."""
    before, notes, after = Observation("landings-in"), Observation("landings-notes"), Observation("landings-out")
    seen = parsed.observe(before, F.count(F.lit(1)).alias("rows_in"),
                          F.count_if(F.coalesce(F.col("weight_kg") <= 0, F.lit(True))).alias("bad_weight"),
                          F.count_if(F.col("landing_date").isNull()).alias("missing_date"),
                          F.count_if(F.col("vessel_id").isNull()).alias("missing_vessel"),
                          F.count_if(F.col("species_code").isNull()).alias("missing_species"),
                          F.count_if(lpad_code("area_code", 2).isNull()).alias("missing_area"))
    single = dedup_notes(seen, prefer_valid).observe(notes, F.count("note_id").alias("distinct_notes"))
    clean = keep_valid(single).observe(after, F.count(F.lit(1)).alias("rows_out"))
    return clean, lambda: {**before.get, **notes.get, **after.get}


def clean_lines_observed(lines: DataFrame, copies: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``clean_landings_observed`` for lines whose area is a function of the vessel
    and is looked up afterwards: each line stands for ``copies`` parsed rows, one
    for each area of its vessel, and none lacks an area.

    The rows left are those of ``clean_landings`` without the area columns. Lines
    of a note that are equal up to the vessel have the same areas, so the first
    row has the first of these (``first_per_key``) and the area decides between
    no two lines (nor does a name that is one of the code); where the first row has no vessel, the note is dropped."""
    before, notes, after = Observation("landings-in"), Observation("landings-notes"), Observation("landings-out")

    def rows(rule: Column = F.lit(True)) -> Column:
        return F.coalesce(F.sum(F.when(rule, F.col(copies)).otherwise(F.lit(0))), F.lit(0))

    seen = lines.observe(before, rows().alias("rows_in"), rows(F.coalesce(F.col("weight_kg") <= 0, F.lit(True))).alias("bad_weight"),
                         rows(F.col("landing_date").isNull()).alias("missing_date"), rows(F.col("vessel_id").isNull()).alias("missing_vessel"),
                         rows(F.col("species_code").isNull()).alias("missing_species"))
    single = dedup_notes(seen.drop(copies)).observe(notes, F.count("note_id").alias("distinct_notes"))
    clean = (single.filter(F.col("weight_kg") > 0).dropna(subset=[k for k in LANDING_KEYS if k != "area_code"])
             .observe(after, F.count(F.lit(1)).alias("rows_out")))
    return clean, lambda: {**before.get, **notes.get, **after.get, "missing_area": 0}


def row_counts(**stages: DataFrame) -> DataFrame:
    """``(stage, rows)`` per named DataFrame, e.g. ``row_counts(bronze=b, silver=s)``."""
    out = None
    for name, df in stages.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
