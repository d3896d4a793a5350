"""Extract queries: catch-line selection, sampling, vessel master, hourly to daily."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import kmh_to_ms, quote_name, strip, to_timestamp_iso
from lakemart.operators import extract as ex
from lakemart.plans import bindings as b
from lakemart.plans import layers
from lakemart.plans import raw_files as raw
from lakemart.plans.catalog import register
from lakemart.plans.oracle import sql
from lakemart.plans.queries.q_sources import _REGISTER_SQL, REGISTER_COLUMNS
from lakemart.sources import bronze, files

# The date range that the extract is cut to (its feature).
START, END = "1995-01-01", "2001-12-31"
NARROW_START, NARROW_END = "1996-01-01", "2000-12-31"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_LEN = "CAST(10 + s.s_suppkey % 30 AS DOUBLE)"
_CATCH = f"""
SELECT CAST(l.l_orderkey AS VARCHAR) AS "Dokumentnummer",
       l.l_returnflag AS "Salgslag (kode)",
       CAST(l.l_linenumber AS VARCHAR) AS "Linjenummer",
       strftime(l.l_shipdate, '%d.%m.%Y') AS "Landingsdato",
       CASE WHEN l.l_tax = CAST(0.08 AS DOUBLE) THEN '' ELSE CAST(l.l_suppkey AS VARCHAR) END AS "Fartøy ID",
       'R-' || CAST(l.l_suppkey AS VARCHAR) AS "Registreringsmerke (seddel)",
       s.s_name AS "Fartøynavn", n.n_name AS "Fartøytype", n.n_name AS "Fartøykommune",
       r.r_name AS "Fartøynasjonalitet",
       CASE WHEN l.l_linenumber = 1 THEN NULL ELSE replace(CAST({_LEN} AS VARCHAR), '.', ',') END AS "Største lengde",
       CAST(CAST(floor({_LEN} / 5) * 5 AS INTEGER) AS VARCHAR) || 'm+' AS "Lengdegruppe",
       CASE WHEN s.s_suppkey % 2 = 0 THEN NULL ELSE CAST(s.s_nationkey * 10 AS VARCHAR) END AS "Bruttotonnasje 1969",
       CAST(s.s_nationkey * 7 AS VARCHAR) AS "Bruttotonnasje annen",
       CAST(CAST(1960 + s.s_suppkey % 60 AS DOUBLE) AS VARCHAR) AS "Byggeår",
       CASE WHEN l.l_linestatus = 'O' THEN NULL ELSE replace(CAST(s.s_acctbal AS VARCHAR), '.', ',') END AS "Motorkraft",
       p.p_type || ' ' AS "Art FAO (kode)",
       CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE lower(p.p_type) END AS "Art FAO",
       CAST(n.n_regionkey AS VARCHAR) || '.0' AS "Hovedområde (kode)",
       r.r_name AS "Hovedområde",
       l.l_linestatus AS "Redskap (kode)",
       CASE WHEN l.l_discount = CAST(0.0 AS DOUBLE) THEN NULL ELSE replace(CAST(l.l_quantity AS VARCHAR), '.', ',') END
         AS "Rundvekt"
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                JOIN supplier s ON l.l_suppkey = s.s_suppkey
                JOIN nation n ON s.s_nationkey = n.n_nationkey
                JOIN region r ON n.n_regionkey = r.r_regionkey"""

_STRIPPED = "regexp_replace(\"Hovedområde (kode)\", '\\.0$', '')"
_CLEAN = f"""
SELECT * REPLACE (trim("Art FAO (kode)") AS "Art FAO (kode)",
                  CASE WHEN length({_STRIPPED}) < 2 THEN lpad({_STRIPPED}, 2, '0') ELSE {_STRIPPED} END
                    AS "Hovedområde (kode)")
FROM catch"""


def _number(col: str) -> str:
    return (f"TRY_CAST(nullif(replace(replace(replace({col}, chr(160), ''), ' ', ''), ',', '.'), '') "
            f"AS DOUBLE)")


def _selected(start: str, end: str) -> str:
    return f"""
SELECT *, CAST(date_trunc('week', landing_date) AS DATE) AS week_start, {_number('"Rundvekt"')} AS weight_num
FROM (SELECT *, CAST(try_strptime("Landingsdato", '%d.%m.%Y') AS DATE) AS landing_date FROM clean
      WHERE "Art FAO (kode)" IN ({_in(raw.EXTRACT_SPECIES)}) AND "Hovedområde (kode)" IN ({_in(raw.EXTRACT_AREAS)}))
WHERE landing_date BETWEEN DATE '{start}' AND DATE '{end}'"""


_REST = [c for c in ex.CATCH_COLUMNS if c not in (ex.DOC, ex.LINE, ex.SPECIES, ex.AREA)]
_ORDER = ", ".join(["landing_date ASC NULLS LAST", '"Dokumentnummer" ASC NULLS LAST',
                    '"Linjenummer" ASC NULLS LAST'] + [f"{_q(c)} ASC NULLS LAST" for c in _REST])
_SAMPLE = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY week_start, "Art FAO (kode)", "Hovedområde (kode)", is_valid
                               ORDER BY {_ORDER}) AS rn
  FROM (SELECT *, coalesce("Fartøy ID" IS NOT NULL AND trim("Fartøy ID") <> '' AND weight_num > 0, false)
                  AS is_valid FROM selected))
WHERE (is_valid AND rn <= 8) OR (NOT is_valid AND rn <= 1)"""
_NAMES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in raw.EXTRACT_NAMES.items())
_LANDING_ROWS = f"""
SELECT concat_ws('-', coalesce("Salgslag (kode)", 'X'), coalesce("Dokumentnummer", 'X'),
                 coalesce("Linjenummer", 'X')) AS "Seddelnummer",
       strftime(landing_date, '%d.%m.%Y') AS "Landingsdato",
       "Fartøy ID", "Art FAO (kode)",
       coalesce("Art FAO", CASE "Art FAO (kode)" {_NAMES} END) AS "Art FAO (navn)",
       "Hovedområde (kode)" AS "Fangstområde (kode)", "Hovedområde" AS "Fangstområde (navn)",
       "Redskap (kode)", weight_num AS "Rundvekt (kg)"
FROM sample"""
_ATTRS = ["Registreringsmerke (seddel)", "Fartøynavn", "Fartøytype", "Fartøykommune", "Fartøynasjonalitet",
          "Største lengde", "Lengdegruppe", "Bruttotonnasje 1969", "Bruttotonnasje annen", "Byggeår", "Motorkraft"]


def _latest(source: str) -> str:
    aggs = ",\n       ".join(
        f"arg_max({_q(c)}, {{'d': landing_date, 'doc': \"Dokumentnummer\", 'line': \"Linjenummer\", "
        f"'v': {_q(c)}}}) FILTER (WHERE {_q(c)} IS NOT NULL) AS {_q(c)}" for c in _ATTRS)
    return f"""
SELECT CAST("Fartøy ID" AS VARCHAR) AS vessel_id,
       {aggs}
FROM {source} WHERE "Fartøy ID" IS NOT NULL AND trim("Fartøy ID") <> '' GROUP BY 1"""


_WIDTHS = f"""
SELECT vessel_id, arg_max({_number('width')}, register_year) FILTER (WHERE {_number('width')} IS NOT NULL) AS width_m
FROM registers GROUP BY 1"""
_MASTER = f"""
SELECT v.vessel_id AS "Fartøy ID", v."Registreringsmerke (seddel)" AS "Registreringsmerke", v."Fartøynavn",
       v."Fartøytype",
       CASE WHEN {_number('v."Største lengde"')} <= 20 THEN 'Kyst' WHEN {_number('v."Største lengde"')} <= 30
            THEN 'Kyst større' WHEN {_number('v."Største lengde"')} IS NOT NULL THEN 'Hav' END AS "Fartøygruppe",
       {_number('v."Største lengde"')} AS "Lengde (meter)", v."Lengdegruppe", w.width_m AS "Bredde (meter)",
       coalesce({_number('v."Bruttotonnasje 1969"')}, {_number('v."Bruttotonnasje annen"')}) AS "Bruttotonnasje",
       {_number('v."Byggeår"')} AS "Byggeår", {_number('v."Motorkraft"')} / 1.36 AS "Motorkraft (kW)",
       v."Fartøykommune" AS "Hjemkommune", v."Fartøynasjonalitet" AS "Nasjonalitet"
FROM selected_latest v LEFT JOIN widths w ON v.vessel_id = w.vessel_id"""


def xsql(final: str, start: str = START, end: str = END) -> str:
    """Base CTEs plus the extract CTEs."""
    ctes = {"catch": _CATCH, "clean": _CLEAN, "selected": _selected(start, end), "sample": _SAMPLE,
            "selected_latest": _latest("selected"), "registers": _REGISTER_SQL, "widths": _WIDTHS,
            "master": _MASTER}
    extra = ",\n".join(f"{k} AS ({v}\n)" for k, v in ctes.items())
    return sql(f", {extra}\n{final}")


def _selected_df(spark, sf, start=START, end=END):
    return ex.select_catch(raw.catch_lines(spark, sf), raw.EXTRACT_SPECIES, raw.EXTRACT_AREAS, start, end)


def _sample(spark, sf):
    return ex.sample_lines(_selected_df(spark, sf))


# -- selection ------------------------------------------------------------------------

@register("filt_codes", xsql("""
SELECT "Dokumentnummer", "Linjenummer", "Art FAO (kode)", "Hovedområde (kode)" FROM clean
WHERE "Art FAO (kode)" IN ('ECONOMY', 'LARGE', 'MEDIUM') AND "Hovedområde (kode)" IN ('01', '02', '03')"""))
def filt_codes(spark, sf):
    rows = ex.filter_codes(ex.clean_codes(raw.catch_lines(spark, sf)), raw.EXTRACT_SPECIES, raw.EXTRACT_AREAS)
    return rows.select(quote_name(ex.DOC), quote_name(ex.LINE), quote_name(ex.SPECIES), quote_name(ex.AREA))


@register("filt_date_range", xsql("""
SELECT "Dokumentnummer", "Linjenummer", landing_date, week_start FROM selected""", NARROW_START, NARROW_END))
def filt_date_range(spark, sf):
    return _selected_df(spark, sf, NARROW_START, NARROW_END).select(
        quote_name(ex.DOC), quote_name(ex.LINE), "landing_date", "week_start")


@register("filt_nonblank", xsql("""
SELECT "Dokumentnummer", "Linjenummer", "Fartøy ID" FROM catch
WHERE "Fartøy ID" IS NOT NULL AND NOT regexp_full_match("Fartøy ID", '\\s*')"""))
def filt_nonblank(spark, sf):
    lines = raw.catch_lines(spark, sf)
    v = quote_name(ex.VESSEL)
    return lines.filter(v.isNotNull() & (strip(v) != "")).select(quote_name(ex.DOC), quote_name(ex.LINE), v)


# -- sampling ---------------------------------------------------------------------------

_SAMPLE_COLS = """week_start, "Art FAO (kode)" AS species_code, "Hovedområde (kode)" AS area_code,
       "Dokumentnummer" AS document, "Linjenummer" AS line, landing_date"""


def _sample_cols(df):
    return df.select("week_start", quote_name(ex.SPECIES).alias("species_code"),
                     quote_name(ex.AREA).alias("area_code"), quote_name(ex.DOC).alias("document"),
                     quote_name(ex.LINE).alias("line"), "landing_date")


@register("win_top8_valid", xsql(f"SELECT {_SAMPLE_COLS} FROM sample WHERE is_valid"))
def win_top8_valid(spark, sf):
    return _sample_cols(_sample(spark, sf).filter("_valid"))


@register("win_top1_invalid", xsql(f"SELECT {_SAMPLE_COLS} FROM sample WHERE NOT is_valid"))
def win_top1_invalid(spark, sf):
    return _sample_cols(_sample(spark, sf).filter(~F.col("_valid")))


@register("set_union_sample", xsql("SELECT * FROM (" + _LANDING_ROWS + ")"))
def set_union_sample(spark, sf):
    """The landings file of the extract: valid and invalid samples together."""
    return ex.landing_rows(ex.sample_lines(ex.require_rows(_selected_df(spark, sf))), raw.EXTRACT_NAMES)


@register("sort_extract", xsql(_LANDING_ROWS + '\nORDER BY week_start, "Art FAO (kode)", "Hovedområde (kode)", landing_date, "Dokumentnummer", "Linjenummer"'))
def sort_extract(spark, sf):
    """The extract in its file order (week, species, area, date, document, line)."""
    return ex.landing_rows(_sample(spark, sf), raw.EXTRACT_NAMES, in_order=True)


@register("fn_concat_key", xsql("""
SELECT "Dokumentnummer", "Linjenummer",
       concat_ws('-', coalesce("Salgslag (kode)", 'X'), coalesce("Dokumentnummer", 'X'), coalesce("Linjenummer", 'X'))
         AS note_id,
       concat_ws('-', coalesce("Art FAO", 'X'), coalesce("Linjenummer", 'X')) AS name_line
FROM catch"""))
def fn_concat_key(spark, sf):
    from lakemart.functions import concat_key
    lines = raw.catch_lines(spark, sf)
    return lines.select(quote_name(ex.DOC), quote_name(ex.LINE),
                        concat_key(quote_name(ex.SALES_ORG), quote_name(ex.DOC), quote_name(ex.LINE)).alias("note_id"),
                        concat_key(quote_name(ex.SPECIES_NAME), quote_name(ex.LINE)).alias("name_line"))


# -- vessel master --------------------------------------------------------------------------

@register("agg_latest_nonnull", xsql("SELECT * FROM (" + _latest("selected") + ")"))
def agg_latest_nonnull(spark, sf):
    """Newest non-NULL value of each vessel attribute over all selected lines."""
    sel = _selected_df(spark, sf)
    src = sel.filter(quote_name(ex.VESSEL).isNotNull() & (strip(quote_name(ex.VESSEL)) != "")) \
        .withColumn("vessel_id", quote_name(ex.VESSEL).cast("string"))
    return ex.latest_non_null(src, "vessel_id", _ATTRS, ["landing_date", ex.DOC, ex.LINE])


def _widths(spark, sf):
    return ex.width_by_vessel(files.register_union(raw.width_registers(spark, sf), REGISTER_COLUMNS))


@register("agg_first_width", xsql("SELECT * FROM widths"))
def agg_first_width(spark, sf):
    return _widths(spark, sf)


@register("join_width", xsql("""
SELECT v.vessel_id, v.vessel_name, w.width_m FROM silver_vessels v LEFT JOIN widths w ON v.vessel_id = w.vessel_id"""))
def join_width(spark, sf):
    return (layers.silver_vessels(spark, sf).select("vessel_id", "vessel_name")
            .join(_widths(spark, sf), "vessel_id", "left"))


@register("extract_vessels", xsql('SELECT * FROM master ORDER BY "Fartøy ID"'))
def extract_vessels(spark, sf):
    """The vessel file of the extract: newest non-NULL attributes of all
    selected lines, register width, length group, engine power in kW; by vessel id."""
    selected = ex.require_rows(_selected_df(spark, sf))
    return ex.vessel_master(selected, _widths(spark, sf)).orderBy(quote_name("Fartøy ID"))


# -- hourly replies -----------------------------------------------------------------------------

_HOURLY_SQL = """
SELECT event_type, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%f') AS time,
       value AS sea_surface_temperature, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS wave_height,
       CAST(user_id AS DOUBLE) AS ocean_current_velocity
FROM events"""


def _hourly(spark, sf):
    """Reply files -> VARIANT Bronze -> one row per reading."""
    return files.open_replies(bronze.jsonl_to_variant(spark, raw.hourly_jsonl(spark, sf)), keep=["event_type"])


@register("src_hourly_arrays", sql(_HOURLY_SQL))
def src_hourly_arrays(spark, sf):
    """Parallel arrays of each reply back to one row per reading."""
    return _hourly(spark, sf)


def _half_up(num: str, den: str, unit: int) -> str:
    """Half-up rounding of num/den to 1/unit in integer arithmetic."""
    return (f"CAST(sign({num}) * ((2 * {unit} * abs({num}) + {den}) // (2 * {den})) AS DOUBLE) / {unit}.0")


_NANO_SUM = "sum(CAST(replace(CAST(CAST(value AS DECIMAL(28,9)) AS VARCHAR), '.', '') AS HUGEINT))"
_K_SUM = "sum(CAST(json_extract_string(props, '$.k') AS HUGEINT))"


@register("agg_hour_to_day", sql(f"""
SELECT event_type, CAST(ts AS DATE) AS date,
       {_half_up(_NANO_SUM, '(1000000000 * CAST(count(value) AS HUGEINT))', 100)} AS sea_temp_c,
       {_half_up(_K_SUM, 'count(*)', 100)}
         AS wave_height_m,
       {_half_up('(10 * sum(CAST(user_id AS HUGEINT)))', '(36 * count(user_id))', 1000)} AS current_speed_ms
FROM events GROUP BY 1, 2"""))
def agg_hour_to_day(spark, sf):
    """Daily means from hourly readings; current km/h to m/s; rounded half-up."""
    return ex.daily_sea(_hourly(spark, sf), keys=["event_type"])


@register("fn_timestamp", sql("""
SELECT event_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour FROM events"""))
def fn_timestamp(spark, sf):
    ev = b.Tables(spark, sf).events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("t"))
    parsed = ev.select("event_id", to_timestamp_iso("t").alias("ts"))
    return parsed.select("event_id", F.to_date("ts").alias("date"), F.hour("ts").alias("hour"))


@register("fn_kmh_ms", sql("""
SELECT event_id, CAST(user_id AS DOUBLE) / 3.6 AS current_speed_ms FROM events"""))
def fn_kmh_ms(spark, sf):
    ev = b.Tables(spark, sf).events
    return ev.select("event_id", kmh_to_ms(F.col("user_id").cast("double")).alias("current_speed_ms"))
