"""Dashboard data: the two datasets and one function per widget.

``history(mart)`` and ``forecast_series(predictions)`` are the datasets; every
widget is an aggregate over one of them, after the shared multi-select filters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import decimal_mean

HISTORY_COLUMNS = ("week_start", "species_code", "species_name", "area_code", "area_name",
                   "landed_kg", "n_notes", "active_vessels", "sea_temp_c", "wave_height_m",
                   "current_speed_ms")
# Series labels of the forecast chart.
ACTUAL = "Faktisk"
PREDICTED = "Predikert"


def history(mart: DataFrame) -> DataFrame:
    return mart.select(*HISTORY_COLUMNS)


def forecast_series(pred: DataFrame) -> DataFrame:
    """Actual and predicted as (series, kg) rows: one scan with ``stack``
    instead of a union of two scans."""
    return pred.select(
        F.col("target_week").alias("week_start"), "species_name", "area_name",
        F.expr(f"stack(2, '{ACTUAL}', target_kg, '{PREDICTED}', predicted_kg) AS (series, kg)"),
    )


def forecast_series_union(pred: DataFrame) -> DataFrame:
    """The same rows as ``forecast_series`` written as UNION ALL."""
    def one(label: str, col: str) -> DataFrame:
        return pred.select(F.col("target_week").alias("week_start"), "species_name", "area_name",
                           F.lit(label).alias("series"), F.col(col).alias("kg"))
    return one(ACTUAL, "target_kg").unionByName(one(PREDICTED, "predicted_kg"))


def filter_predicate(species: Sequence[str] | None = None, areas: Sequence[str] | None = None,
                     species_col: str = "species_name", area_col: str = "area_name") -> Column:
    """Multi-select filters; an empty or missing selection means no filter."""
    cond = F.lit(True)
    if species:
        cond = cond & F.col(species_col).isin(list(species))
    if areas:
        cond = cond & F.col(area_col).isin(list(areas))
    return cond


def apply_filters(df: DataFrame, species=None, areas=None) -> DataFrame:
    return df.filter(filter_predicate(species, areas))


def facet_counts(df: DataFrame, facet: str, other: Column) -> DataFrame:
    """Per value of ``facet``: rows passing the *other* filters (associative
    filter counts); values with 0 stay listed."""
    return df.groupBy(facet).agg(F.count_if(other).alias("n_rows"))


def facets(df: DataFrame, dataset: str, filters: Mapping[str, Sequence]) -> DataFrame:
    """(dataset, facet, value, n_rows): every value of each filter column with the
    rows that pass the *other* filters. All facets come from one scan: one
    grouping set a column, each with the count of its own predicate."""
    columns = list(filters)
    counts = []
    for c in columns:
        others = F.lit(True)
        for other in columns:
            if other != c and filters[other]:
                others = others & F.coalesce(F.col(other).isin(list(filters[other])), F.lit(False))
        counts.append(F.count_if(others).alias(f"_n_{c}"))
    grouped = df.select(*columns).groupingSets([[c] for c in columns], *columns).agg(*counts, *[F.grouping(c).alias(f"_out_{c}") for c in columns])
    pick = lambda make: F.coalesce(*[F.when(F.col(f"_out_{c}") == 0, make(c)) for c in columns])
    return grouped.select(F.lit(dataset).alias("dataset"), pick(F.lit).alias("facet"), pick(lambda c: F.col(c).cast("string")).alias("value"),
                          pick(lambda c: F.col(f"_n_{c}")).alias("n_rows"))


def kpi_total_kg(hist: DataFrame) -> DataFrame:
    return hist.agg(F.sum("landed_kg").alias("total_kg"))


def kpi_max_vessels(hist: DataFrame) -> DataFrame:
    return hist.agg(F.max("active_vessels").alias("max_active_vessels"))


def kg_by_week_species(hist: DataFrame) -> DataFrame:
    return (hist.groupBy("week_start", "species_name").agg(F.sum("landed_kg").alias("landed_kg"))
            .orderBy("week_start", "species_name"))


def kg_by_species(hist: DataFrame) -> DataFrame:
    return hist.groupBy("species_name").agg(F.sum("landed_kg").alias("landed_kg"))


def kg_ranked(hist: DataFrame, *keys: str) -> DataFrame:
    """Landed kg by any columns, largest first, equal ones by the columns."""
    return hist.groupBy(*keys).agg(F.sum("landed_kg").alias("landed_kg")).orderBy(F.desc("landed_kg"), *keys)


def kg_by_area(hist: DataFrame) -> DataFrame:
    return kg_ranked(hist, "area_name")


def kg_by_week_series(series: DataFrame) -> DataFrame:
    return (series.groupBy("week_start", "series").agg(F.sum("kg").alias("kg"))
            .orderBy("week_start", "series"))


def kg_by_species_series(series: DataFrame) -> DataFrame:
    return (series.groupBy("species_name", "series").agg(F.sum("kg").alias("kg"))
            .orderBy("species_name", "series"))


def sea_by_week(mart: DataFrame) -> DataFrame:
    """Suggested extra charts: mean wave height and sea temperature per week
    (rounded to six places at the end),
    and number of landings."""
    return mart.groupBy("week_start").agg(
        F.round(decimal_mean("wave_height_m"), 6).alias("wave_height_m"),
        F.round(decimal_mean("sea_temp_c"), 6).alias("sea_temp_c"),
        F.sum("n_notes").alias("n_notes"),
    )
