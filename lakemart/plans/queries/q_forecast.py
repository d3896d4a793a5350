"""Forecast queries: model input, split, forest fit, predictions, importances."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.operators import features as feat
from lakemart.operators import forecast as fc
from lakemart.operators import metrics
from lakemart.plans import bindings as b
from lakemart.plans import layers
from lakemart.plans.catalog import register
from lakemart.plans.oracle import sql
from lakemart.session import scratch_path
from lakemart.sources import sinks

_MODELS: dict = {}
_ROWS: dict = {}


def _feature_names() -> list[str]:
    return feat.feature_columns(layers.species_levels())


def _model_rows(spark, sf):
    """Model input written once per session and data folder (small: one row
    per week x species x area), shared by the training and holdout splits."""
    key = (spark.sparkContext.applicationId, sf, layers.version(spark, sf))
    if key not in _ROWS:
        _ROWS[key] = sinks.materialize(layers.model_rows(spark, sf), "model-rows")
    return _ROWS[key]


def _split(spark, sf):
    rows = _model_rows(spark, sf)
    return layers.train_rows(rows, year=b.TEST_YEAR), layers.test_rows(rows)


def _model(spark, sf, params: fc.ForestParams = fc.ForestParams(), encode_species: bool = False):
    """Fitted pipeline per (data folder, settings), reused within a session."""
    key = (spark.sparkContext.applicationId, sf, layers.version(spark, sf), params, encode_species)
    if key not in _MODELS:
        train, _ = _split(spark, sf)
        names = [c for c in _feature_names() if not (encode_species and c.startswith("species_"))]
        _MODELS[key] = fc.fit(train, names, params, encode_species)
    return _MODELS[key]


def _scored(spark, sf):
    _, test = _split(spark, sf)
    return fc.predict(_model(spark, sf), test)


_FEATURE_SQL = ", ".join(
    ["species_code", "area_code", "week_start", "area_id", "iso_week", "round(week_sin, 10) AS week_sin",
     "round(week_cos, 10) AS week_cos", "landed_kg", "lag_1", "lag_4", "mean_4", "lag_8", "mean_8", "n_notes",
     "active_vessels", "avg_length_m", "avg_power_kw", "sea_temp_c", "wave_height_m", "current_speed_ms"]
    + [f"CAST(coalesce(month = {m}, false) AS INTEGER) AS month_{m}" for m in range(1, 13)]
    + [f"CAST(coalesce(species_id = {s}, false) AS INTEGER) AS species_{s}" for s in (1, 2, 3, 99)]
    + ["target_kg"])


@register("ml_features", sql(f"SELECT {_FEATURE_SQL} FROM model_rows"))
def ml_features(spark, sf):
    """Model input before assembly: complete rows, trend, month and species one-hots."""
    rows = layers.model_rows(spark, sf)
    cols = [c if c not in ("week_sin", "week_cos") else F.round(c, 10).alias(c) for c in _feature_names()]
    return rows.select("species_code", "area_code", "week_start", *cols, "target_kg")


@register("filt_complete", sql("SELECT species_code, area_code, week_start, target_kg FROM model_rows"))
def filt_complete(spark, sf):
    return layers.model_rows(spark, sf).select("species_code", "area_code", "week_start", "target_kg")


@register("filt_train", sql("""
SELECT species_code, area_code, week_start, target_week FROM model_rows WHERE target_week <= DATE '2001-06-25' AND target_year = 2001"""))
def filt_train(spark, sf):
    train, _ = _split(spark, sf)
    return train.select("species_code", "area_code", "week_start", "target_week")


@register("filt_test", sql("""
SELECT species_code, area_code, week_start, target_week FROM model_rows WHERE target_year = 2001 AND target_month = 7"""))
def filt_test(spark, sf):
    _, test = _split(spark, sf)
    return test.select("species_code", "area_code", "week_start", "target_week")


@register("ml_split", sql("""
SELECT 'train' AS part, CAST(count(*) AS BIGINT) AS rows FROM model_rows WHERE target_week <= DATE '2001-06-25' AND target_year = 2001
UNION ALL
SELECT 'test', CAST(count(*) AS BIGINT) FROM model_rows WHERE target_year = 2001 AND target_month = 7"""))
def ml_split(spark, sf):
    train, test = _split(spark, sf)
    return (train.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("train").alias("part"), "rows")
            .unionByName(test.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("test").alias("part"), "rows")))


@register("win_trend_grouped", sql("""
SELECT species_code, area_code, week_start, landed_kg, round(mean_8, 9) AS mean_8, round(lag_8, 9) AS lag_8
FROM trend"""))
def win_trend_grouped(spark, sf):
    """Trend features of every series, at 9 places (one window exchange; no
    series is gathered in a Python worker)."""
    out = feat.add_trend(layers.mart(spark, sf))
    return out.select("species_code", "area_code", "week_start", "landed_kg",
                      F.round("mean_8", 9).alias("mean_8"), F.round("lag_8", 9).alias("lag_8"))


@register("ml_species_levels", sql("""
SELECT CAST(row_number() OVER (ORDER BY species_id) - 1 AS INTEGER) AS idx, species_id
FROM (SELECT DISTINCT CAST(species_id AS VARCHAR) AS species_id FROM model_rows WHERE target_week <= DATE '2001-06-25' AND target_year = 2001)"""))
def ml_species_levels(spark, sf):
    train, _ = _split(spark, sf)
    return fc.species_levels(train)


@register("ml_fit")
def ml_fit(spark, sf):
    """Random forest (250 trees, depth 12) fitted on the training weeks;
    returns its holdout predictions."""
    return fc.predictions(_scored(spark, sf))


@register("ml_predict")
def ml_predict(spark, sf):
    return _scored(spark, sf).select("species_code", "area_code", "week_start", "target_week", "predicted_kg")


@register("ml_predictions")
def ml_predictions(spark, sf):
    """Predictions written to a table and read back."""
    path = scratch_path(spark, "predictions")
    name = f"predictions_{path.rsplit('-', 1)[-1]}"
    sinks.write_table(fc.predictions(_scored(spark, sf)), name, path=path)
    return spark.read.table(name)


@register("ml_importance")
def ml_importance(spark, sf):
    names = [c for c in _feature_names()]
    train, _ = _split(spark, sf)
    return fc.importances(_model(spark, sf), names, train)


@register("ml_by_species")
def ml_by_species(spark, sf):
    return metrics.by_species(fc.predictions(_scored(spark, sf)))


@register("ml_evaluate_forest")
def ml_evaluate_forest(spark, sf):
    return metrics.overall(fc.predictions(_scored(spark, sf)))


@register("ml_fit_encoded")
def ml_fit_encoded(spark, sf):
    """Forest with species levels learnt by StringIndexer + OneHotEncoder in
    the pipeline instead of fixed one-hot columns."""
    _, test = _split(spark, sf)
    model = _model(spark, sf, encode_species=True)
    return fc.predictions(fc.predict(model, test, encode_species=True))
