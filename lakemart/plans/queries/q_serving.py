"""Dashboard widgets and forecast metrics over the mart and PRED."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import kg_to_tonnes, pct_deviation, decimal_sum
from lakemart.operators import metrics, serving
from lakemart.plans import layers
from lakemart.plans.catalog import register
from lakemart.plans.oracle import sql

# Dashboard filter selection used by the bound filter queries.
SPECIES_PICK = ("economy", "large", "promo")
AREA_PICK = ("ASIA", "EUROPE")
_SP = ", ".join(f"'{s}'" for s in SPECIES_PICK)
_AR = ", ".join(f"'{a}'" for a in AREA_PICK)


def _hist(spark, sf):
    return serving.history(layers.mart(spark, sf))


def _series(spark, sf):
    return serving.forecast_series(layers.pred_baseline(spark, sf))


def _total(col: str) -> str:
    return f"CAST(sum(CAST({col} AS DECIMAL(38,9))) AS DOUBLE)"


# -- datasets -------------------------------------------------------------------

@register("proj_history", sql("SELECT * FROM history"))
def proj_history(spark, sf):
    return _hist(spark, sf)


@register("pred_baseline", sql("SELECT * FROM pred"))
def pred_baseline(spark, sf):
    return layers.pred_baseline(spark, sf)


@register("proj_unpivot_series", sql("SELECT * FROM series"))
def proj_unpivot_series(spark, sf):
    return _series(spark, sf)


@register("set_union_series", sql("SELECT * FROM series"))
def set_union_series(spark, sf):
    return serving.forecast_series_union(layers.pred_baseline(spark, sf))


@register("proj_literal_series", sql("""
SELECT target_week AS week_start, species_name, area_name, 'Predikert' AS series, predicted_kg AS kg
FROM pred"""))
def proj_literal_series(spark, sf):
    pred = layers.pred_baseline(spark, sf)
    return pred.select(F.col("target_week").alias("week_start"), "species_name", "area_name",
                       F.lit(serving.PREDICTED).alias("series"), F.col("predicted_kg").alias("kg"))


# -- widgets ----------------------------------------------------------------------

@register("kpi_total", sql("SELECT sum(landed_kg) AS total_kg FROM history"))
def kpi_total(spark, sf):
    return serving.kpi_total_kg(_hist(spark, sf))


@register("kpi_max_vessels", sql("SELECT max(active_vessels) AS max_active_vessels FROM history"))
def kpi_max_vessels(spark, sf):
    return serving.kpi_max_vessels(_hist(spark, sf))


@register("dash_week_species", sql("""
SELECT week_start, species_name, sum(landed_kg) AS landed_kg FROM history GROUP BY 1, 2 ORDER BY 1, 2"""))
def dash_week_species(spark, sf):
    return serving.kg_by_week_species(_hist(spark, sf))


@register("dash_species", sql("SELECT species_name, sum(landed_kg) AS landed_kg FROM history GROUP BY 1"))
def dash_species(spark, sf):
    return serving.kg_by_species(_hist(spark, sf))


@register("dash_area", sql("""
SELECT area_name, sum(landed_kg) AS landed_kg FROM history GROUP BY 1 ORDER BY 2 DESC, 1"""))
def dash_area(spark, sf):
    return serving.kg_by_area(_hist(spark, sf))


@register("sort_agg_desc", sql("""
SELECT species_name, area_name, sum(landed_kg) AS landed_kg FROM history GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2"""))
def sort_agg_desc(spark, sf):
    """Species and areas by landed kg, largest first."""
    return serving.kg_ranked(_hist(spark, sf), "species_name", "area_name")


@register("dash_week_series", sql(f"""
SELECT week_start, series, {_total('kg')} AS kg FROM series GROUP BY 1, 2 ORDER BY 1, 2"""))
def dash_week_series(spark, sf):
    s = _series(spark, sf)
    return (s.groupBy("week_start", "series").agg(decimal_sum("kg").alias("kg"))
            .orderBy("week_start", "series"))


@register("dash_species_series", sql(f"""
SELECT species_name, series, {_total('kg')} AS kg FROM series GROUP BY 1, 2 ORDER BY 1, 2"""))
def dash_species_series(spark, sf):
    s = _series(spark, sf)
    return (s.groupBy("species_name", "series").agg(decimal_sum("kg").alias("kg"))
            .orderBy("species_name", "series"))


@register("filt_multi_select", sql(f"""
SELECT * FROM history WHERE species_name IN ({_SP}) AND area_name IN ({_AR})"""))
def filt_multi_select(spark, sf):
    return serving.apply_filters(_hist(spark, sf), SPECIES_PICK, AREA_PICK)


@register("filt_multi_select_empty", sql(f"SELECT * FROM history WHERE species_name IN ({_SP})"))
def filt_multi_select_empty(spark, sf):
    """An empty area selection means no area filter."""
    return serving.apply_filters(_hist(spark, sf), SPECIES_PICK, [])


@register("filt_multi_select_pred", sql(f"""
SELECT * FROM series WHERE species_name IN ({_SP}) AND area_name IN ({_AR})"""))
def filt_multi_select_pred(spark, sf):
    return serving.apply_filters(_series(spark, sf), SPECIES_PICK, AREA_PICK)


@register("dash_facet_count", sql(f"""
SELECT species_name, CAST(count_if(area_name IN ({_AR})) AS BIGINT) AS n_rows FROM history GROUP BY 1"""))
def dash_facet_count(spark, sf):
    """Species filter values with the rows that pass the area filter."""
    other = serving.filter_predicate(areas=AREA_PICK)
    return serving.facet_counts(_hist(spark, sf), "species_name", other)


@register("dash_facet_count_area", sql(f"""
SELECT area_name, CAST(count_if(species_name IN ({_SP})) AS BIGINT) AS n_rows FROM history GROUP BY 1"""))
def dash_facet_count_area(spark, sf):
    other = serving.filter_predicate(species=SPECIES_PICK)
    return serving.facet_counts(_hist(spark, sf), "area_name", other)


@register("dash_facets", sql("\nUNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{facet}' AS facet, {facet} AS value, CAST(count_if({other}) AS BIGINT) AS n_rows FROM {table} GROUP BY {facet}"
    for name, table in (("historikk", "history"), ("prognose", "series"))
    for facet, other in (("species_name", f"area_name IN ({_AR})"), ("area_name", f"species_name IN ({_SP})")))))
def dash_facets(spark, sf):
    """Both filters over both datasets: four facets, one scan a dataset."""
    picked = {"species_name": SPECIES_PICK, "area_name": AREA_PICK}
    return (serving.facets(_hist(spark, sf), "historikk", picked)
            .unionByName(serving.facets(_series(spark, sf), "prognose", picked)))


@register("dash_sea_series", sql("""
SELECT week_start,
       round(CAST(sum(CAST(wave_height_m AS DECIMAL(38,9))) AS DOUBLE) / CAST(count(wave_height_m) AS DOUBLE), 6) AS wave_height_m,
       round(CAST(sum(CAST(sea_temp_c AS DECIMAL(38,9))) AS DOUBLE) / CAST(count(sea_temp_c) AS DOUBLE), 6) AS sea_temp_c,
       CAST(sum(n_notes) AS BIGINT) AS n_notes FROM mart GROUP BY 1"""))
def dash_sea_series(spark, sf):
    return serving.sea_by_week(layers.mart(spark, sf))


# -- metrics on PRED ---------------------------------------------------------------

_ERR = "abs(target_kg - predicted_kg)"
_MAE = f"round(avg({_ERR}), 6)"
_RMSE = f"round(sqrt(avg({_ERR} * {_ERR})), 6)"
_WMAPE = f"round(sum({_ERR}) / nullif(sum(abs(target_kg)), 0.0) * 100.0, 6)"


@register("agg_mae", sql(f"SELECT {_MAE} AS mae FROM pred"))
def agg_mae(spark, sf):
    return metrics.mae(layers.pred_baseline(spark, sf))


@register("agg_rmse", sql(f"SELECT {_RMSE} AS rmse FROM pred"))
def agg_rmse(spark, sf):
    return metrics.rmse(layers.pred_baseline(spark, sf))


@register("agg_wmape", sql(f"SELECT {_WMAPE} AS wmape FROM pred"))
def agg_wmape(spark, sf):
    return metrics.wmape(layers.pred_baseline(spark, sf))


@register("ml_evaluate", sql(f"""
SELECT CAST(count(*) AS BIGINT) AS n_obs, {_MAE} AS mae, {_RMSE} AS rmse, {_WMAPE} AS wmape FROM pred"""))
def ml_evaluate(spark, sf):
    return metrics.overall(layers.pred_baseline(spark, sf))


_BY_GROUP = """
SELECT {key}, n_obs, total_actual_kg, total_predicted_kg,
       round(total_predicted_kg - total_actual_kg, 6) AS deviation_kg,
       round((total_predicted_kg - total_actual_kg) / nullif(total_actual_kg, 0.0) * 100.0, 6) AS deviation_pct,
       mae, wmape
FROM (SELECT {key}, CAST(count(*) AS BIGINT) AS n_obs,
             """ + f"""{_total('target_kg')} AS total_actual_kg, {_total('predicted_kg')} AS total_predicted_kg,
             {_MAE} AS mae, {_WMAPE} AS wmape""" + """
      FROM pred GROUP BY 1)
ORDER BY wmape DESC NULLS LAST, {key}"""
_BY_SPECIES = _BY_GROUP.format(key="species_name")


@register("agg_metrics_by_species", sql(_BY_SPECIES))
def agg_metrics_by_species(spark, sf):
    return metrics.by_species(layers.pred_baseline(spark, sf))


@register("sort_metrics", sql(_BY_GROUP.format(key="area_name")))
def sort_metrics(spark, sf):
    """The metrics of each area, worst WMAPE first."""
    return metrics.worst_first(metrics.by_group(layers.pred_baseline(spark, sf), "area_name"), "area_name")


@register("agg_pred_by_week", sql(f"""
SELECT target_week, {_total('target_kg')} AS target_kg, {_total('predicted_kg')} AS predicted_kg
FROM pred GROUP BY 1 ORDER BY 1"""))
def agg_pred_by_week(spark, sf):
    return metrics.by_target_week(layers.pred_baseline(spark, sf))


@register("fn_abs_error", sql("""
SELECT week_start, species_code, area_code, abs(target_kg - predicted_kg) AS abs_error_kg FROM pred"""))
def fn_abs_error(spark, sf):
    return layers.pred_baseline(spark, sf).select("week_start", "species_code", "area_code", "abs_error_kg")


@register("fn_pct_dev", sql("""
SELECT week_start, species_code, area_code,
       (predicted_kg - target_kg) / nullif(target_kg, 0.0) * 100.0 AS pct_deviation FROM pred"""))
def fn_pct_dev(spark, sf):
    return layers.pred_baseline(spark, sf).select(
        "week_start", "species_code", "area_code",
        pct_deviation("predicted_kg", "target_kg").alias("pct_deviation"))


@register("fn_kg_tonnes", sql("""
SELECT target_week, species_name, target_kg / 1000.0 AS target_t, predicted_kg / 1000.0 AS predicted_t
FROM pred"""))
def fn_kg_tonnes(spark, sf):
    return layers.pred_baseline(spark, sf).select(
        "target_week", "species_name", kg_to_tonnes("target_kg").alias("target_t"),
        kg_to_tonnes("predicted_kg").alias("predicted_t"))
