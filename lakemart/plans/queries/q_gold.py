"""Gold queries: dimensions, fact joins, weekly aggregates, mart and windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.operators import features as feat
from lakemart.operators import gold
from lakemart.operators.joins import broadcast_if_fits, fits_broadcast
from lakemart.plans import bindings as b
from lakemart.plans import layers
from lakemart.plans.catalog import register
from lakemart.plans.oracle import hashed, sql

GRAIN = "week_start, species_code, species_name, area_code, area_name"


def _lv(spark, sf):
    tables = layers.shared(spark, sf)
    return gold.landings_with_vessel(tables.silver_landings, tables.silver_vessels, fits_broadcast(tables.silver_vessels))


# -- dimensions -------------------------------------------------------------

@register("distinct_pairs", sql("SELECT DISTINCT species_code, species_name FROM silver_landings"))
def distinct_pairs(spark, sf):
    return gold.code_pairs(layers.shared(spark, sf).silver_landings, "species_code", "species_name")


_SPECIES_KEYS = hashed("silver_landings", "species_code", "species_key")
_AREA_KEYS = hashed("silver_landings", "area_code", "area_key")
_VESSEL_KEYS = hashed("silver_vessels", "vessel_id", "vessel_key")
HASHED_FACT = sql(f"""
SELECT l.note_id, CAST(strftime(l.landing_date, '%Y%m%d') AS INTEGER) AS date_key, v.vessel_key,
       CASE WHEN l.species_name IS NOT NULL THEN s.species_key END AS species_key,
       CASE WHEN l.area_name IS NOT NULL THEN a.area_key END AS area_key,
       l.landing_date, l.vessel_id, l.species_code, l.area_code, l.gear_code, l.weight_kg
FROM silver_landings l LEFT JOIN {_VESSEL_KEYS} v USING (vessel_id)
LEFT JOIN {_SPECIES_KEYS} s USING (species_code) LEFT JOIN {_AREA_KEYS} a USING (area_code)""")


@register("dim_species", sql(f"""
SELECT k.species_key, d.* FROM (SELECT DISTINCT species_code, species_name FROM silver_landings) d LEFT JOIN {_SPECIES_KEYS} k USING (species_code)"""))
def dim_species(spark, sf):
    return gold.dim_species(layers.shared(spark, sf).silver_landings)


@register("dim_area", sql(f"""
SELECT k.area_key, d.* FROM (SELECT DISTINCT area_code, area_name FROM silver_landings) d LEFT JOIN {_AREA_KEYS} k USING (area_code)"""))
def dim_area(spark, sf):
    return gold.dim_area(layers.shared(spark, sf).silver_landings)


@register("dim_vessel", sql(f"SELECT k.vessel_key, v.* FROM silver_vessels v LEFT JOIN {_VESSEL_KEYS} k USING (vessel_id)"))
def dim_vessel(spark, sf):
    return gold.dim_vessel(layers.shared(spark, sf).silver_vessels)


@register("dim_date", sql("""
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, * FROM calendar"""))
def dim_date(spark, sf):
    return gold.dim_date(layers.shared(spark, sf).silver_calendar)


@register("dim_key_unique", sql("""
SELECT 'species' AS dim, CAST(count(DISTINCT species_code) AS BIGINT) AS n_codes,
       CAST(count(DISTINCT species_code) AS BIGINT) AS n_keys FROM silver_landings
UNION ALL
SELECT 'area', CAST(count(DISTINCT area_code) AS BIGINT), CAST(count(DISTINCT area_code) AS BIGINT)
FROM silver_landings"""))
def dim_key_unique(spark, sf):
    """Hash keys are one-to-one with codes: distinct codes = distinct keys."""
    landings = layers.shared(spark, sf).silver_landings
    sp = gold.dim_species(landings).agg(F.countDistinct("species_code").alias("n_codes"),
                                        F.countDistinct("species_key").alias("n_keys"))
    ar = gold.dim_area(landings).agg(F.countDistinct("area_code").alias("n_codes"),
                                     F.countDistinct("area_key").alias("n_keys"))
    return (sp.select(F.lit("species").alias("dim"), "n_codes", "n_keys")
            .unionByName(ar.select(F.lit("area").alias("dim"), "n_codes", "n_keys")))


# -- fact joins ---------------------------------------------------------------

@register("join_dim_species", sql("""
SELECT l.note_id, l.species_code, l.species_name, d.species_code IS NOT NULL AS species_found
FROM silver_landings l LEFT JOIN (SELECT DISTINCT species_code, species_name FROM silver_landings) d
  ON l.species_code = d.species_code AND l.species_name = d.species_name"""))
def join_dim_species(spark, sf):
    tables = layers.shared(spark, sf)
    dim = broadcast_if_fits(tables.dim_species)
    return (tables.silver_landings.join(dim, ["species_code", "species_name"], "left")
            .select("note_id", "species_code", "species_name",
                    F.col("species_key").isNotNull().alias("species_found")))


@register("join_dim_area", sql("""
SELECT l.note_id, l.area_code, l.area_name, d.area_code IS NOT NULL AS area_found
FROM silver_landings l LEFT JOIN (SELECT DISTINCT area_code, area_name FROM silver_landings) d
  ON l.area_code = d.area_code AND l.area_name = d.area_name"""))
def join_dim_area(spark, sf):
    tables = layers.shared(spark, sf)
    dim = broadcast_if_fits(tables.dim_area)
    return (tables.silver_landings.join(dim, ["area_code", "area_name"], "left")
            .select("note_id", "area_code", "area_name", F.col("area_key").isNotNull().alias("area_found")))


@register("join_dim_vessel", sql("""
SELECT l.note_id, l.vessel_id, v.vessel_id IS NOT NULL AS vessel_found
FROM silver_landings l LEFT JOIN silver_vessels v ON l.vessel_id = v.vessel_id"""))
def join_dim_vessel(spark, sf):
    tables = layers.shared(spark, sf)
    return (tables.silver_landings.join(broadcast_if_fits(tables.dim_vessel.select("vessel_id", "vessel_key")), "vessel_id", "left")
            .select("note_id", "vessel_id", F.col("vessel_key").isNotNull().alias("vessel_found")))


@register("join_dim_date", sql("""
SELECT l.note_id, l.landing_date, CAST(strftime(c.date, '%Y%m%d') AS INTEGER) AS date_key
FROM silver_landings l LEFT JOIN calendar c ON l.landing_date = c.date"""))
def join_dim_date(spark, sf):
    landings = layers.shared(spark, sf).silver_landings
    dates = layers.shared(spark, sf).dim_date
    return (landings.join(broadcast_if_fits(dates.select(F.col("date").alias("landing_date"), "date_key")),
                          "landing_date", "left")
            .select("note_id", "landing_date", "date_key"))


@register("fact_landings", HASHED_FACT)
def fact_landings(spark, sf):
    """The fact over the written Silver and vessel dimension, joined without a
    shuffle of the fact: by broadcast behind the size check, else by buckets."""
    return layers.shared(spark, sf).fact_plan()


@register("fact_landings_joined", HASHED_FACT)
def fact_landings_joined(spark, sf):
    """The same fact by a left join to each of the four written dimensions."""
    t = layers.shared(spark, sf)
    return gold.fact_landings(t.silver_landings, t.dim_species, t.dim_area, t.dim_vessel, t.dim_date)


@register("fact_landings_checked", sql("""
SELECT l.note_id, CAST(strftime(l.landing_date, '%Y%m%d') AS INTEGER) AS date_key, l.landing_date,
       l.vessel_id, l.species_code, l.area_code, l.gear_code, l.weight_kg,
       v.vessel_id IS NOT NULL AS vessel_found, s.species_code IS NOT NULL AS species_found, a.area_code IS NOT NULL AS area_found
FROM silver_landings l LEFT JOIN silver_vessels v ON l.vessel_id = v.vessel_id
LEFT JOIN (SELECT DISTINCT species_code, species_name FROM silver_landings) s ON l.species_code = s.species_code AND l.species_name = s.species_name
LEFT JOIN (SELECT DISTINCT area_code, area_name FROM silver_landings) a ON l.area_code = a.area_code AND l.area_name = a.area_name"""))
def fact_landings_checked(spark, sf):
    """The fact with hash keys replaced by found flags (SQL-checkable form)."""
    found = [F.col(f"{d}_key").isNotNull().alias(f"{d}_found") for d in ("vessel", "species", "area")]
    return (fact_landings(spark, sf)
            .select("note_id", "date_key", "landing_date", "vessel_id", "species_code", "area_code",
                    "gear_code", "weight_kg", *found))


# -- written layers -------------------------------------------------------------

@register("layer_counts", sql("""
SELECT 'silver_landings' AS layer, CAST(count(*) AS BIGINT) AS rows FROM silver_landings
UNION ALL SELECT 'silver_vessels', CAST(count(*) AS BIGINT) FROM silver_vessels
UNION ALL SELECT 'silver_sea', CAST(count(*) AS BIGINT) FROM silver_sea
UNION ALL SELECT 'silver_calendar', CAST(count(*) AS BIGINT) FROM calendar
UNION ALL SELECT 'dim_species', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT species_code, species_name FROM silver_landings)
UNION ALL SELECT 'dim_area', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT area_code, area_name FROM silver_landings)
UNION ALL SELECT 'dim_vessel', CAST(count(*) AS BIGINT) FROM silver_vessels
UNION ALL SELECT 'dim_date', CAST(count(*) AS BIGINT) FROM calendar
UNION ALL SELECT 'fact_landings', CAST(count(*) AS BIGINT) FROM silver_landings
UNION ALL SELECT 'mart', CAST(count(*) AS BIGINT) FROM mart
UNION ALL SELECT 'features', CAST(count(*) AS BIGINT) FROM features"""))
def layer_counts(spark, sf):
    """The whole pipeline: every layer written once; rows of each table."""
    counts = [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"))
              for name, df in layers.shared(spark, sf).build().items()]
    return reduce(DataFrame.unionByName, counts)


@register("layer_silver_landings", sql("SELECT * FROM silver_landings"))
def layer_silver_landings(spark, sf):
    return layers.shared(spark, sf).silver_landings


@register("layer_mart", sql("SELECT * FROM mart"))
def layer_mart(spark, sf):
    return layers.shared(spark, sf).mart


@register("layer_features", sql("""
SELECT * REPLACE (round(week_sin, 10) AS week_sin, round(week_cos, 10) AS week_cos) FROM features"""))
def layer_features(spark, sf):
    df = layers.shared(spark, sf).features
    return df.withColumn("week_sin", F.round("week_sin", 10)).withColumn("week_cos", F.round("week_cos", 10))


@register("join_vessel_attrs", sql("SELECT * FROM lv"))
def join_vessel_attrs(spark, sf):
    return _lv(spark, sf)


# -- weekly aggregates ----------------------------------------------------------

@register("agg_week_volume", sql("SELECT * FROM week_volume"))
def agg_week_volume(spark, sf):
    return gold.week_volume(_lv(spark, sf))


@register("dedup_grain_vessel", sql(f"SELECT DISTINCT {GRAIN}, vessel_id FROM lv"))
def dedup_grain_vessel(spark, sf):
    return _lv(spark, sf).select(*gold.WEEK_GRAIN, "vessel_id").dropDuplicates(gold.WEEK_GRAIN + ["vessel_id"])


@register("agg_week_fleet", sql("SELECT * FROM week_fleet"))
def agg_week_fleet(spark, sf):
    return gold.week_fleet(_lv(spark, sf))


@register("join_volume_fleet", sql(f"""
SELECT vo.*, f.active_vessels, f.avg_length_m, f.avg_power_kw
FROM week_volume vo LEFT JOIN week_fleet f USING ({GRAIN})"""))
def join_volume_fleet(spark, sf):
    return gold.week_volume_fleet(_lv(spark, sf))


@register("agg_week_sea", sql("SELECT * FROM week_sea"))
def agg_week_sea(spark, sf):
    return gold.week_sea(layers.shared(spark, sf).silver_sea)


@register("filt_monday", sql("SELECT * FROM calendar WHERE weekday = 1"))
def filt_monday(spark, sf):
    return layers.shared(spark, sf).silver_calendar.filter(F.col("weekday") == 1)


@register("dedup_week", sql("SELECT * FROM week_calendar"))
def dedup_week(spark, sf):
    return gold.week_calendar(layers.shared(spark, sf).silver_calendar)


@register("join_sea_week", sql(f"""
SELECT vo.*, s.sea_temp_c, s.wave_height_m, s.current_speed_ms
FROM week_volume vo LEFT JOIN week_sea s USING (week_start, area_code)"""))
def join_sea_week(spark, sf):
    return gold.week_volume(_lv(spark, sf)).join(gold.week_sea(layers.shared(spark, sf).silver_sea),
                                                 ["week_start", "area_code"], "left")


@register("join_week_calendar", sql("""
SELECT vo.*, c.iso_week, c.month, c.season FROM week_volume vo LEFT JOIN week_calendar c USING (week_start)"""))
def join_week_calendar(spark, sf):
    return gold.week_volume(_lv(spark, sf)).join(
        broadcast_if_fits(gold.week_calendar(layers.shared(spark, sf).silver_calendar)), "week_start", "left")


@register("mart_week", sql("SELECT * FROM mart"))
def mart_week(spark, sf):
    """The mart computed from the written Silver tables."""
    return layers.shared(spark, sf).mart_plan()


@register("mart_week_joined", sql("SELECT * FROM mart"))
def mart_week_joined(spark, sf):
    t = layers.shared(spark, sf)
    return gold.weekly_mart_joined(t.silver_landings, t.silver_vessels, t.silver_sea, t.silver_calendar, b.BOUND_SPECIES_IDS,
                                   fits_broadcast(t.silver_vessels))


@register("sort_preview", sql(f"SELECT * FROM mart ORDER BY {GRAIN} LIMIT 20"))
def sort_preview(spark, sf):
    """Top-20 preview by the full grain (a total order, so the 20 are fixed)."""
    return layers.mart(spark, sf).orderBy(*gold.WEEK_GRAIN).limit(20)


# -- windows ----------------------------------------------------------------------

_SERIES = "species_code, area_code, week_start"


@register("win_lag_1", sql(f"SELECT {_SERIES}, lag_1 FROM features"))
def win_lag_1(spark, sf):
    return feat.add_lags(layers.mart(spark, sf)).select("species_code", "area_code", "week_start", "lag_1")


@register("win_lag_4", sql(f"SELECT {_SERIES}, lag_4 FROM features"))
def win_lag_4(spark, sf):
    return feat.add_lags(layers.mart(spark, sf)).select("species_code", "area_code", "week_start", "lag_4")


@register("win_mean_4", sql(f"SELECT {_SERIES}, mean_4 FROM features"))
def win_mean_4(spark, sf):
    return feat.add_lags(layers.mart(spark, sf)).select("species_code", "area_code", "week_start", "mean_4")


@register("win_lead_target", sql(f"SELECT {_SERIES}, target_week, target_kg FROM features"))
def win_lead_target(spark, sf):
    return layers.features(spark, sf).select("species_code", "area_code", "week_start", "target_week",
                                             "target_kg")


@register("win_lag_8", sql(f"SELECT {_SERIES}, lag_8 FROM trend"))
def win_lag_8(spark, sf):
    return feat.add_trend(layers.mart(spark, sf)).select("species_code", "area_code", "week_start", "lag_8")


@register("win_mean_8", sql(f"SELECT {_SERIES}, mean_8 FROM trend"))
def win_mean_8(spark, sf):
    return feat.add_trend(layers.mart(spark, sf)).select("species_code", "area_code", "week_start", "mean_8")


@register("fn_cyclic", sql("""
SELECT week_start, iso_week, round(sin(2 * pi() * iso_week / 52.0), 10) AS week_sin,
       round(cos(2 * pi() * iso_week / 52.0), 10) AS week_cos FROM week_calendar"""))
def fn_cyclic(spark, sf):
    from lakemart.functions import week_cos, week_sin
    weeks = gold.week_calendar(layers.shared(spark, sf).silver_calendar)
    # sin/cos differ between math libraries in the last bit: compare at 10 places.
    return weeks.select("week_start", "iso_week", F.round(week_sin("iso_week"), 10).alias("week_sin"),
                        F.round(week_cos("iso_week"), 10).alias("week_cos"))


@register("mart_features", sql("""
SELECT * REPLACE (round(week_sin, 10) AS week_sin, round(week_cos, 10) AS week_cos) FROM features"""))
def mart_features(spark, sf):
    df = layers.features(spark, sf)
    return df.withColumn("week_sin", F.round("week_sin", 10)).withColumn("week_cos", F.round("week_cos", 10))


@register("win_dense_weeks", sql("""
SELECT s.species_code, s.area_code, s.week_start, coalesce(m.landed_kg, 0.0) AS landed_kg, m.n_notes
FROM (SELECT species_code, area_code, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week_start
      FROM (SELECT species_code, area_code, min(week_start) AS lo, max(week_start) AS hi
            FROM mart GROUP BY 1, 2)) s
LEFT JOIN mart m ON s.species_code = m.species_code AND s.area_code = m.area_code
     AND s.week_start = m.week_start"""))
def win_dense_weeks(spark, sf):
    """Week spine per series (missing weeks as 0 kg) so lags count weeks."""
    mart = layers.mart(spark, sf).select("species_code", "area_code", "week_start", "landed_kg", "n_notes")
    return feat.dense_weeks(mart)


_CARRIED = ", ".join(f"CASE WHEN given IS NULL THEN last_value({c} IGNORE NULLS) OVER c ELSE {c} END AS {c}" for c in feat.CARRIED)


@register("mart_features_dense", sql(f"""
SELECT *, round(sin(2 * pi() * iso_week / 52.0), 10) AS week_sin, round(cos(2 * pi() * iso_week / 52.0), 10) AS week_cos,
       CAST(week_start + INTERVAL 7 DAY AS DATE) AS target_week,
       CAST(year(week_start + INTERVAL 7 DAY) AS INTEGER) AS target_year, CAST(month(week_start + INTERVAL 7 DAY) AS INTEGER) AS target_month
FROM (SELECT *, lag(landed_kg, 1) OVER w AS lag_1, lag(landed_kg, 4) OVER w AS lag_4,
             avg(landed_kg) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS mean_4, lead(landed_kg, 1) OVER w AS target_kg
      FROM (SELECT species_code, area_code, week_start, coalesce(landed_kg, 0.0) AS landed_kg, coalesce(n_notes, 0) AS n_notes, {_CARRIED},
                   CAST(weekofyear(week_start) AS INTEGER) AS iso_week, CAST(month(week_start) AS INTEGER) AS month,
                   CASE WHEN month(week_start) IN (12, 1, 2) THEN 'vinter' WHEN month(week_start) IN (3, 4, 5) THEN 'vaar'
                        WHEN month(week_start) IN (6, 7, 8) THEN 'sommer' ELSE 'hoest' END AS season
            FROM (SELECT s.species_code, s.area_code, s.week_start, m.* EXCLUDE (species_code, area_code, week_start)
                  FROM (SELECT species_code, area_code, CAST(unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY)) AS DATE) AS week_start
                        FROM mart GROUP BY 1, 2) s
                  LEFT JOIN (SELECT *, true AS given FROM mart) m USING (species_code, area_code, week_start))
            WINDOW c AS (PARTITION BY species_code, area_code ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
      WINDOW w AS (PARTITION BY species_code, area_code ORDER BY week_start))"""))
def mart_features_dense(spark, sf):
    """Features on dense weeks: inserted weeks carry ids, names, fleet and sea."""
    df = feat.feature_mart(layers.mart(spark, sf), dense=True)
    return df.withColumn("week_sin", F.round("week_sin", 10)).withColumn("week_cos", F.round("week_cos", 10))


@register("fn_hash_key", sql(f"""
SELECT DISTINCT l.species_code, l.area_code, s.species_key, a.area_key
FROM silver_landings l LEFT JOIN {_SPECIES_KEYS} s USING (species_code) LEFT JOIN {_AREA_KEYS} a USING (area_code)"""))
def fn_hash_key(spark, sf):
    """64-bit xxHash keys of the species and area codes."""
    from lakemart.functions import hash_key
    landings = layers.shared(spark, sf).silver_landings
    return landings.select("species_code", "area_code", hash_key("species_code").alias("species_key"),
                           hash_key("area_code").alias("area_key")).distinct()


@register("proj_key_first", sql("""
SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, * FROM silver_sea"""))
def proj_key_first(spark, sf):
    """A key column in front of all columns of a table, whatever they are."""
    from lakemart.functions import date_key
    sea = layers.shared(spark, sf).silver_sea
    out = gold.key_first(sea, "date_key", date_key("date"))
    assert out.columns == ["date_key", *sea.columns]
    return out


@register("proj_rename", sql("""
SELECT CAST(s_suppkey AS VARCHAR) AS vessel_id, s_name AS vessel_name, s_acctbal AS power_kw FROM supplier"""))
def proj_rename(spark, sf):
    s = b.Tables(spark, sf).supplier
    return (s.select(F.col("s_suppkey").cast("string").alias("s_suppkey"), "s_name", "s_acctbal")
            .withColumnRenamed("s_suppkey", "vessel_id").withColumnRenamed("s_name", "vessel_name")
            .withColumnRenamed("s_acctbal", "power_kw"))


@register("proj_drop_helper", sql("SELECT vessel_id, build_year FROM silver_vessels"))
def proj_drop_helper(spark, sf):
    """The row-number helper of the latest-row rule is dropped from the output."""
    out = layers.shared(spark, sf).silver_vessels
    assert "_rn" not in out.columns
    return out.select("vessel_id", "build_year")
