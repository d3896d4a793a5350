"""Scalar function queries over the bound rows (section 2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart import functions as fn
from lakemart.operators import extract as ex
from lakemart.operators import features as feat
from lakemart.plans import bindings as b
from lakemart.plans import layers
from lakemart.plans import raw_files as raw
from lakemart.plans.catalog import register
from lakemart.plans.oracle import sql
from lakemart.plans.queries.q_extract import _number, xsql

_STRIP_AREA = "regexp_replace(\"Hovedområde (kode)\", '\\.0$', '')"
_WEIGHT_DOT = "replace(\"Rundvekt\", ',', '.')"


def _lines(spark, sf):
    return raw.catch_lines(spark, sf)


def _c(name):
    return fn.quote_name(name)


@register("fn_dayfirst", xsql("""
SELECT "Dokumentnummer", "Linjenummer",
       CAST(try_strptime("Landingsdato", '%d.%m.%Y') AS DATE) AS dotted,
       CAST(try_strptime(replace("Landingsdato", '.', '/'), '%d/%m/%Y') AS DATE) AS slashed
FROM catch"""))
def fn_dayfirst(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.to_date_dayfirst(_c(ex.DATE)).alias("dotted"),
                        fn.to_date_dayfirst(F.replace(_c(ex.DATE), F.lit("."), F.lit("/"))).alias("slashed"))


@register("fn_zfill", xsql(f"""
SELECT "Dokumentnummer", "Linjenummer",
       CASE WHEN length({_STRIP_AREA}) < 2 THEN lpad({_STRIP_AREA}, 2, '0') ELSE {_STRIP_AREA} END AS area_2,
       "Hovedområde (kode)" AS area_uncut
FROM catch"""))
def fn_zfill(spark, sf):
    """Pads short codes, never cuts long ones (``3.0`` stays ``3.0``)."""
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.zfill_code(fn.strip_dot0(_c(ex.AREA))).alias("area_2"),
                        fn.zfill_code(_c(ex.AREA)).alias("area_uncut"))


@register("fn_strip_dot0", xsql(f"""
SELECT "Dokumentnummer", "Linjenummer", {_STRIP_AREA} AS area,
       regexp_replace({_WEIGHT_DOT}, '\\.0$', '') AS weight_text,
       regexp_replace(replace("Motorkraft", ',', '.'), '\\.0$', '') AS power_text
FROM catch"""))
def fn_strip_dot0(spark, sf):
    """Only a trailing ``.0`` goes (``8752.05`` keeps its digits)."""
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.strip_dot0(_c(ex.AREA)).alias("area"),
                        fn.strip_dot0(F.replace(_c(ex.WEIGHT), F.lit(","), F.lit("."))).alias("weight_text"),
                        fn.strip_dot0(F.replace(_c("Motorkraft"), F.lit(","), F.lit("."))).alias("power_text"))


@register("fn_to_number", xsql(f"""
SELECT "Dokumentnummer", "Linjenummer", {_number('"Rundvekt"')} AS weight, {_number('"Motorkraft"')} AS hp,
       {_number('"Største lengde"')} AS length, {_number('"Fartøynavn"')} AS not_a_number
FROM catch"""))
def fn_to_number(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.to_number(_c(ex.WEIGHT)).alias("weight"),
                        fn.to_number(_c("Motorkraft")).alias("hp"), fn.to_number(_c("Største lengde")).alias("length"),
                        fn.to_number(_c("Fartøynavn")).alias("not_a_number"))


@register("fn_try_number", xsql("""
SELECT "Dokumentnummer", "Linjenummer", TRY_CAST(trim("Bruttotonnasje 1969") AS DOUBLE) AS gt,
       TRY_CAST(trim("Lengdegruppe") AS DOUBLE) AS bad
FROM catch"""))
def fn_try_number(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.try_number(_c("Bruttotonnasje 1969")).alias("gt"),
                        fn.try_number(_c("Lengdegruppe")).alias("bad"))


@register("fn_strip", xsql("""
SELECT "Dokumentnummer", "Linjenummer", trim("Art FAO (kode)") AS species_code FROM catch"""))
def fn_strip(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.strip(_c(ex.SPECIES)).alias("species_code"))


@register("fn_coalesce", xsql(f"""
SELECT "Dokumentnummer", "Linjenummer",
       coalesce({_number('"Bruttotonnasje 1969"')}, {_number('"Bruttotonnasje annen"')}) AS gross_tonnage
FROM catch"""))
def fn_coalesce(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE),
                        F.coalesce(fn.to_number(_c("Bruttotonnasje 1969")),
                                   fn.to_number(_c("Bruttotonnasje annen"))).alias("gross_tonnage"))


@register("fn_hp_kw", xsql(f"""
SELECT "Dokumentnummer", "Linjenummer", {_number('"Motorkraft"')} / 1.36 AS power_kw FROM catch"""))
def fn_hp_kw(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(_c(ex.DOC), _c(ex.LINE), fn.hp_to_kw(fn.to_number(_c("Motorkraft"))).alias("power_kw"))


@register("fn_bins", sql("""
SELECT vessel_id, length_m,
       CASE WHEN length_m <= 20 THEN 'Kyst' WHEN length_m <= 30 THEN 'Kyst større'
            WHEN length_m IS NOT NULL THEN 'Hav' END AS vessel_group,
       CASE WHEN length_m + 0.5 <= 20 THEN 'Kyst' WHEN length_m + 0.5 <= 30 THEN 'Kyst større'
            WHEN length_m + 0.5 IS NOT NULL THEN 'Hav' END AS group_half_up
FROM silver_vessels"""))
def fn_bins(spark, sf):
    """Right-closed length bins: 20 is coast, 20.5 larger coast, 30.5 ocean."""
    v = layers.silver_vessels(spark, sf)
    return v.select("vessel_id", "length_m", fn.vessel_group("length_m").alias("vessel_group"),
                    fn.vessel_group(F.col("length_m") + F.lit(0.5)).alias("group_half_up"))


@register("fn_date_text", sql("""
SELECT note_id, strftime(landing_date, '%d.%m.%Y') AS day_first, strftime(landing_date, '%Y-%m-%d') AS iso
FROM silver_landings"""))
def fn_date_text(spark, sf):
    rows = layers.silver_landings(spark, sf)
    return rows.select("note_id", fn.date_text("landing_date", "dd.MM.yyyy").alias("day_first"),
                       fn.date_text("landing_date").alias("iso"))


@register("fn_week_start", sql("""
SELECT note_id, landing_date, CAST(date_trunc('week', landing_date) AS DATE) AS week_start FROM silver_landings"""))
def fn_week_start(spark, sf):
    rows = layers.silver_landings(spark, sf)
    return rows.select("note_id", "landing_date", fn.week_start("landing_date").alias("week_start"))


@register("fn_date_key", sql("""
SELECT note_id, CAST(strftime(landing_date, '%Y%m%d') AS INTEGER) AS date_key FROM silver_landings"""))
def fn_date_key(spark, sf):
    return layers.silver_landings(spark, sf).select("note_id", fn.date_key("landing_date").alias("date_key"))


@register("fn_date_add", sql("""
SELECT week_start, CAST(week_start + INTERVAL 7 DAY AS DATE) AS target_week FROM week_calendar"""))
def fn_date_add(spark, sf):
    from lakemart.operators import gold
    weeks = gold.week_calendar(layers.silver_calendar(spark, sf))
    return weeks.select("week_start", F.date_add("week_start", 7).alias("target_week"))


@register("fn_year_month", sql("""
SELECT note_id, CAST(year(landing_date) AS INTEGER) AS year, CAST(month(landing_date) AS INTEGER) AS month
FROM silver_landings"""))
def fn_year_month(spark, sf):
    rows = layers.silver_landings(spark, sf)
    return rows.select("note_id", fn.year_of("landing_date").alias("year"), fn.month_of("landing_date").alias("month"))


@register("fn_iso_week", sql("""
SELECT note_id, CAST(weekofyear(landing_date) AS INTEGER) AS iso_week FROM silver_landings"""))
def fn_iso_week(spark, sf):
    return layers.silver_landings(spark, sf).select("note_id", fn.iso_week("landing_date").alias("iso_week"))


@register("fn_iso_weekday", sql("""
SELECT note_id, CAST(isodow(landing_date) AS INTEGER) AS weekday FROM silver_landings"""))
def fn_iso_weekday(spark, sf):
    return layers.silver_landings(spark, sf).select("note_id", fn.iso_weekday("landing_date").alias("weekday"))


@register("fn_weekend", sql("SELECT note_id, isodow(landing_date) >= 6 AS is_weekend FROM silver_landings"))
def fn_weekend(spark, sf):
    return layers.silver_landings(spark, sf).select("note_id", fn.is_weekend("landing_date").alias("is_weekend"))


@register("fn_holiday", sql("""
SELECT l.note_id, c.is_holiday FROM silver_landings l JOIN calendar c ON l.landing_date = c.date"""))
def fn_holiday(spark, sf):
    return layers.silver_landings(spark, sf).select("note_id", fn.is_public_holiday("landing_date").alias("is_holiday"))


@register("fn_easter", sql("""
SELECT DISTINCT CAST(e.y AS INTEGER) AS year, e.easter FROM easter e JOIN (SELECT DISTINCT year FROM calendar) c ON c.year = e.y"""))
def fn_easter(spark, sf):
    """Easter Sunday of each year of the data's calendar."""
    from lakemart.functions.dates import easter_sunday
    years = layers.shared(spark, sf).silver_calendar.select("year").distinct()
    return years.select("year", easter_sunday(F.col("year")).alias("easter"))


@register("fn_season", sql("""
SELECT note_id, CASE WHEN month(landing_date) IN (12, 1, 2) THEN 'vinter' WHEN month(landing_date) IN (3, 4, 5)
            THEN 'vaar' WHEN month(landing_date) IN (6, 7, 8) THEN 'sommer' ELSE 'hoest' END AS season
FROM silver_landings"""))
def fn_season(spark, sf):
    return layers.silver_landings(spark, sf).select("note_id", fn.season(F.month("landing_date")).alias("season"))


@register("fn_species_id", sql("""
SELECT note_id, CASE species_code WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 99 END
         AS species_id,
       99 AS reference_map_id
FROM silver_landings"""))
def fn_species_id(spark, sf):
    """Bound species map, and the reference map (COD/HAD/POK) which maps all of these to 99."""
    rows = layers.silver_landings(spark, sf)
    return rows.select("note_id", fn.species_id("species_code", b.BOUND_SPECIES_IDS).alias("species_id"),
                       fn.species_id("species_code").alias("reference_map_id"))


@register("fn_area_id", sql("""
SELECT note_id, TRY_CAST(area_code AS INTEGER) AS area_id, TRY_CAST(area_code || 'A' AS INTEGER) AS bad_id
FROM silver_landings"""))
def fn_area_id(spark, sf):
    rows = layers.silver_landings(spark, sf)
    return rows.select("note_id", fn.area_id("area_code").alias("area_id"),
                       fn.area_id(F.concat("area_code", F.lit("A"))).alias("bad_id"))


@register("fn_round", sql("""
SELECT note_id, round(CAST(weight_kg / 8 AS DECIMAL(20,3)), 2)::DOUBLE AS eighth_kg FROM landings"""))
def fn_round(spark, sf):
    """Half-up rounding on exact decimals; NULL stays NULL."""
    rows = b.landings(spark, sf)
    return rows.select("note_id", F.round((F.col("weight_kg") / 8).cast("decimal(20,3)"), 2).cast("double")
                       .alias("eighth_kg"))


@register("fn_one_hot", sql("""
SELECT species_code, area_code, week_start,
       """ + ", ".join(f"CAST(coalesce(month = {m}, false) AS INTEGER) AS month_{m}" for m in range(1, 13)) + """,
       """ + ", ".join(f"CAST(coalesce(species_id = {s}, false) AS INTEGER) AS species_{s}"
                       for s in (1, 2, 3, 99)) + """
FROM mart"""))
def fn_one_hot(spark, sf):
    mart = layers.mart(spark, sf)
    return mart.select("species_code", "area_code", "week_start",
                       *fn.one_hot("month", feat.MONTHS, "month"),
                       *fn.one_hot("species_id", layers.species_levels(), "species"))
