"""Silver queries: dedups, quality filters, latest vessel, typed sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import lpad_code
from lakemart.operators import silver
from lakemart.plans import bindings as b
from lakemart.plans import layers
from lakemart.plans.catalog import register
from lakemart.plans.oracle import sql

_KEYS_NOT_NULL = ("landing_date IS NOT NULL AND vessel_id IS NOT NULL AND species_code IS NOT NULL "
                  "AND area_code IS NOT NULL")


@register("dedup_note", sql("SELECT * FROM notes_dedup"))
def dedup_note(spark, sf):
    return silver.dedup_notes(b.landings(spark, sf))


@register("filt_positive", sql("SELECT * FROM landings WHERE weight_kg > 0"))
def filt_positive(spark, sf):
    return b.landings(spark, sf).filter(F.col("weight_kg") > 0)


@register("filt_dropna", sql(f"SELECT * FROM landings WHERE {_KEYS_NOT_NULL}"))
def filt_dropna(spark, sf):
    return b.landings(spark, sf).dropna(subset=list(silver.LANDING_KEYS))


@register("silver_landings", sql("SELECT * FROM silver_landings"))
def silver_landings(spark, sf):
    return layers.silver_landings(spark, sf)


@register("dedup_note_prefer_valid", sql(f"""
SELECT note_id, landing_date, vessel_id, species_code, species_name, lpad(area_code, 2, '0') AS area_code,
       area_name, gear_code, weight_kg
FROM (SELECT *, row_number() OVER (PARTITION BY note_id ORDER BY
        coalesce(weight_kg > 0 AND {_KEYS_NOT_NULL}, false) DESC,
        landing_date ASC NULLS LAST, vessel_id ASC NULLS LAST, species_code ASC NULLS LAST,
        species_name ASC NULLS LAST, area_code ASC NULLS LAST, area_name ASC NULLS LAST,
        gear_code ASC NULLS LAST, weight_kg ASC NULLS LAST) AS rn FROM landings)
WHERE rn = 1 AND weight_kg > 0 AND {_KEYS_NOT_NULL}"""))
def dedup_note_prefer_valid(spark, sf):
    return layers.silver_landings(spark, sf, prefer_valid=True)


@register("filt_valid_split", sql(f"""
SELECT *, coalesce(weight_kg > 0 AND {_KEYS_NOT_NULL}, false) AS is_valid FROM landings"""))
def filt_valid_split(spark, sf):
    """Valid rows and their exact complement in one pass (valid + invalid = all)."""
    return silver.tag_valid(b.landings(spark, sf))


@register("win_latest", sql("SELECT * FROM silver_vessels"))
def win_latest(spark, sf):
    return layers.silver_vessels(spark, sf)


@register("dedup_date_area", sql("SELECT * FROM silver_sea"))
def dedup_date_area(spark, sf):
    return layers.silver_sea(spark, sf)


@register("dedup_date", sql("SELECT * FROM calendar"))
def dedup_date(spark, sf):
    cal = b.calendar_table(spark, sf)
    return silver.clean_calendar(cal.unionByName(cal))


_COUNTS = sql("""
SELECT CAST(count(*) AS BIGINT) AS rows_in,
       CAST(count(DISTINCT note_id) AS BIGINT) AS distinct_notes,
       CAST(count_if(coalesce(weight_kg <= 0, true)) AS BIGINT) AS bad_weight,
       CAST(count_if(landing_date IS NULL) AS BIGINT) AS missing_date,
       CAST(count_if(vessel_id IS NULL) AS BIGINT) AS missing_vessel,
       CAST(count_if(species_code IS NULL) AS BIGINT) AS missing_species,
       CAST(count_if(lpad(area_code, 2, '0') IS NULL) AS BIGINT) AS missing_area
FROM landings""")


@register("agg_row_count", _COUNTS)
def agg_row_count(spark, sf):
    """Rows in, distinct notes and broken rules, counted while Silver is written
    (one run of the dedup serves the table and its counts)."""
    tables = layers.shared(spark, sf)
    tables.silver_landings  # noqa: B018 - writes the layer, if nothing has done so yet
    counts = tables.landing_counts()
    names = ("rows_in", "distinct_notes", "bad_weight", "missing_date", "missing_vessel", "missing_species", "missing_area")
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@register("agg_row_count_scan", _COUNTS)
def agg_row_count_scan(spark, sf):
    """The same counts by an aggregate of their own over the typed rows."""
    return silver.quality_counts(b.landings(spark, sf))


@register("agg_row_count_stages", sql("""
SELECT 'parsed' AS stage, CAST(count(*) AS BIGINT) AS rows FROM landings
UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM silver_landings"""))
def agg_row_count_stages(spark, sf):
    return silver.row_counts(parsed=b.landings(spark, sf), silver=layers.silver_landings(spark, sf))


@register("fn_lpad", sql("""
SELECT note_id, area_code, lpad(area_code, 2, '0') AS area_code_2,
       lpad(area_code || area_code || area_code, 2, '0') AS area_code_cut FROM landings"""))
def fn_lpad(spark, sf):
    rows = b.landings(spark, sf)
    return rows.select("note_id", "area_code", lpad_code("area_code").alias("area_code_2"),
                       lpad_code(F.concat("area_code", "area_code", "area_code")).alias("area_code_cut"))
