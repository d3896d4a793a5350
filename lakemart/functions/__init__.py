"""Column expressions used across the layers (all JVM-side, codegen friendly)."""

from lakemart.functions.codes import (
    AREA_NAMES,
    SPECIES_IDS,
    SPECIES_NAMES,
    area_id,
    concat_key,
    lpad_code,
    one_hot,
    species_id,
    strip_dot0,
    vessel_group,
    zfill_code,
)
from lakemart.functions.dates import (
    date_key,
    date_text,
    is_holiday,
    is_public_holiday,
    is_weekend,
    iso_week,
    iso_weekday,
    month_of,
    season,
    to_date_dayfirst,
    to_date_fmt,
    to_date_iso,
    to_timestamp_iso,
    week_start,
    year_of,
)
from lakemart.functions.numeric import (
    abs_error,
    decimal_mean,
    decimal_sum,
    hp_to_kw,
    kg_to_tonnes,
    kmh_to_ms,
    pct_deviation,
    round_keep_null,
    strip,
    to_number,
    try_number,
    week_cos,
    week_sin,
)
from lakemart.functions.variant import hash_key, parse_json, quote_name, variant_field

__all__ = [
    "AREA_NAMES", "SPECIES_IDS", "SPECIES_NAMES", "abs_error", "area_id", "concat_key",
    "date_key", "date_text", "hash_key", "hp_to_kw",
    "is_holiday", "is_public_holiday", "is_weekend", "iso_week", "iso_weekday", "kg_to_tonnes", "kmh_to_ms",
    "lpad_code", "month_of", "one_hot", "parse_json", "pct_deviation", "quote_name",
    "round_keep_null", "decimal_mean", "decimal_sum", "season", "species_id", "strip", "strip_dot0", "to_date_dayfirst",
    "to_date_fmt", "to_date_iso", "to_number", "to_timestamp_iso", "try_number",
    "variant_field", "vessel_group", "week_cos", "week_sin", "week_start", "year_of",
    "zfill_code",
]
