"""Forecast evaluation as aggregates (no driver-side loops).

Errors are taken as they are and each result is rounded once at the end, so
the order in which rows meet does not show. Divisions by a zero total give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import decimal_sum

ACTUAL = "target_kg"
PREDICTED = "predicted_kg"


def _err() -> Column:
    return F.abs(F.col(ACTUAL) - F.col(PREDICTED))


def _ratio(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


def metric_columns(places: int = 6) -> list[Column]:
    """MAE, RMSE, WMAPE (percent) over the rows of a group."""
    n = F.count(F.lit(1)).cast("double")
    mae = _ratio(F.sum(_err()), n)
    mse = _ratio(F.sum(_err() * _err()), n)
    wmape = _ratio(F.sum(_err()), F.sum(F.abs(ACTUAL))) * F.lit(100.0)
    return [F.round(mae, places).alias("mae"), F.round(F.sqrt(mse), places).alias("rmse"), F.round(wmape, places).alias("wmape")]


def overall(pred: DataFrame, places: int = 6) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("n_obs"), *metric_columns(places))


def mae(pred: DataFrame, places: int = 6) -> DataFrame:
    return overall(pred, places).select("mae")


def rmse(pred: DataFrame, places: int = 6) -> DataFrame:
    return overall(pred, places).select("rmse")


def wmape(pred: DataFrame, places: int = 6) -> DataFrame:
    return overall(pred, places).select("wmape")


def by_species(pred: DataFrame, key: str = "species_name", places: int = 6) -> DataFrame:
    """``by_group`` of the species; worst WMAPE first."""
    return worst_first(by_group(pred, key, places), key)


def worst_first(groups: DataFrame, *keys: str, metric: str = "wmape") -> DataFrame:
    """Groups by a metric, largest first, unknown last, equal ones by their keys."""
    return groups.orderBy(F.desc_nulls_last(metric), *keys)


def by_group(pred: DataFrame, key: str, places: int = 6) -> DataFrame:
    """Per value of ``key``: n, total actual and predicted, deviation (kg and %),
    MAE, WMAPE."""
    total_actual = decimal_sum(ACTUAL)
    total_pred = decimal_sum(PREDICTED)
    out = pred.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_obs"),
        total_actual.alias("total_actual_kg"),
        total_pred.alias("total_predicted_kg"),
        *metric_columns(places),
    )
    out = out.withColumn("deviation_kg", F.round(F.col("total_predicted_kg") - F.col("total_actual_kg"), places))
    out = out.withColumn("deviation_pct", F.round(_ratio(F.col("deviation_kg"), F.col("total_actual_kg")) * F.lit(100.0), places))
    return out.select(key, "n_obs", "total_actual_kg", "total_predicted_kg", "deviation_kg",
                      "deviation_pct", "mae", "wmape")


def by_target_week(pred: DataFrame) -> DataFrame:
    """Actual and predicted totals per target week (the chart behind the model)."""
    return (pred.groupBy("target_week")
            .agg(decimal_sum(ACTUAL).alias("target_kg"), decimal_sum(PREDICTED).alias("predicted_kg"))
            .orderBy("target_week"))
