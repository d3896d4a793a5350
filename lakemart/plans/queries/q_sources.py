"""Source and sink queries: raw files to Bronze and back to typed rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions import parse_json, quote_name, to_date_fmt, to_date_iso, variant_field
from lakemart.operators import silver
from lakemart.plans import bindings as b
from lakemart.plans import layers
from lakemart.plans import raw_files as raw
from lakemart.plans.catalog import register
from lakemart.plans.oracle import sql
from lakemart.session import scratch_path
from lakemart.sources import bronze, files, sinks
from lakemart.sources.calendar import lookup

# -- Bronze ingest ----------------------------------------------------------------


def _bronze_landings(spark, sf):
    return bronze.csv_to_variant(spark, raw.landings_csv(spark, sf), delimiter=";")


@register("src_csv_semicolon", sql("SELECT * FROM landings"))
def src_csv_semicolon(spark, sf):
    """``;`` CSV -> VARIANT Bronze -> typed landings (equal to the source rows)."""
    return silver.parse_landings(_bronze_landings(spark, sf)).drop("_ingest_ts")


@register("proj_variant_typed", sql("""
SELECT date, CAST(area_code AS INTEGER) AS area_number, wave_height_m, CAST(wave_height_m AS DECIMAL(14,2)) AS wave_cents,
       CAST(NULL AS INTEGER) AS name_as_number, CAST(NULL AS VARCHAR) AS no_such_field FROM sea_raw"""))
def proj_variant_typed(spark, sf):
    """One projection gives a payload's fields the types asked for: date, integer
    from text, double, decimal; a value that does not cast and a field that is
    not there are NULL."""
    fields = [("dato", "date", "date"), ("fangstomrade_kode", "int", "area_number"), ("bolgehoyde_m", "double", "wave_height_m"),
              ("bolgehoyde_m", "decimal(14,2)", "wave_cents"), ("fangstomrade_navn", "int", "name_as_number"), ("mangler", "string", "no_such_field")]
    return silver.variant_select(bronze.jsonl_to_variant(spark, raw.sea_jsonl(spark, sf)), fields)


@register("silver_from_bronze", sql("SELECT * FROM silver_landings"))
def silver_from_bronze(spark, sf):
    """File -> Bronze -> Silver equals Silver built from the typed view."""
    parsed = silver.parse_landings(_bronze_landings(spark, sf)).drop("_ingest_ts")
    return silver.clean_landings(parsed)


@register("src_csv_variant", sql("SELECT * EXCLUDE (register_year) FROM vessels_raw"))
def src_csv_variant(spark, sf):
    """``,`` CSV (build year written as ``1999.0``) -> Bronze -> typed vessels."""
    return silver.parse_vessels(bronze.csv_to_variant(spark, raw.vessels_csv(spark, sf)))


@register("proj_variant_quoted_path", sql("""
SELECT vessel_id, vessel_name, length_m, build_year FROM vessels_raw"""))
def proj_variant_quoted_path(spark, sf):
    """Fields with spaces, parentheses and non-ASCII letters by ``$["..."]`` path."""
    br = bronze.csv_to_variant(spark, raw.vessels_csv(spark, sf))
    return br.select(
        F.try_variant_get("payload", '$["Fartøy ID"]', "string").alias("vessel_id"),
        F.try_variant_get("payload", '$["Fartøynavn"]', "string").alias("vessel_name"),
        F.try_variant_get("payload", '$["Lengde (meter)"]', "double").alias("length_m"),
        F.try_variant_get("payload", '$["Byggeår"]', "double").cast("int").alias("build_year"),
    )


@register("win_latest_from_bronze", sql("SELECT * FROM silver_vessels"))
def win_latest_from_bronze(spark, sf):
    return silver.latest_vessels(silver.parse_vessels(bronze.csv_to_variant(spark, raw.vessels_csv(spark, sf))))


@register("src_csv_batch", sql("""
SELECT 'vessels' AS source, CAST(count(*) AS BIGINT) AS rows FROM vessels_raw
UNION ALL SELECT 'calendar', CAST(count(*) AS BIGINT) FROM calendar"""))
def src_csv_batch(spark, sf):
    """Several files through the same ingest; rows per Bronze table."""
    tables = bronze.ingest_many(spark, [(raw.vessels_csv(spark, sf), "vessels", ","),
                                        (raw.calendar_csv(spark, sf), "calendar", ",")])
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@register("src_calendar_csv", sql("SELECT * FROM calendar"))
def src_calendar_csv(spark, sf):
    """Calendar file (``True``/``False`` texts) -> Bronze -> typed, deduplicated."""
    return silver.clean_calendar(silver.parse_calendar(bronze.csv_to_variant(spark, raw.calendar_csv(spark, sf))))


@register("src_jsonl_variant", sql("SELECT * FROM sea_raw"))
def src_jsonl_variant(spark, sf):
    """JSON Lines -> Bronze -> typed sea readings."""
    return silver.parse_sea(bronze.jsonl_to_variant(spark, raw.sea_jsonl(spark, sf)))


@register("dedup_date_area_from_bronze", sql("SELECT * FROM silver_sea"))
def dedup_date_area_from_bronze(spark, sf):
    return silver.clean_sea(silver.parse_sea(bronze.jsonl_to_variant(spark, raw.sea_jsonl(spark, sf))))


@register("src_file_path", sql("""
SELECT 'year=' || year(landing_date) AS folder, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS rows_of_year
FROM landings WHERE landing_date IS NOT NULL GROUP BY 1"""))
def src_file_path(spark, sf):
    """Lineage: rows per source folder of landings written by year, and how many
    of them are of that year."""
    files_of_years = bronze.csv_to_variant(spark, raw.landings_csv_by_year(spark, sf), delimiter=";")
    typed = silver.variant_select(files_of_years, silver.LANDING_FIELDS[:2], keep=["_source_file"])
    folder = F.regexp_extract("_source_file", r"/(year=\d+)/", 1)
    of_year = F.concat(F.lit("year="), F.substring("landing_date", 7, 4)) == F.col("folder")
    return typed.withColumn("folder", folder).groupBy("folder").agg(F.count(F.lit(1)).alias("rows"), F.count_if(of_year).alias("rows_of_year"))


@register("src_ingest_ts", sql("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(1 AS BIGINT) AS ingest_times, true AS within_the_run FROM landings"))
def src_ingest_ts(spark, sf):
    """Load time: one value per ingest run, not before it nor in the future."""
    began = F.lit(spark.sql("SELECT current_timestamp()").first()[0])
    return _bronze_landings(spark, sf).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("_ingest_ts").alias("ingest_times"),
        F.bool_and(F.col("_ingest_ts").between(began, F.current_timestamp())).alias("within_the_run"))


@register("src_variant_schema", sql("""
SELECT 'OBJECT<`Art FAO (kode)`: STRING, `Art FAO (navn)`: STRING, `Fangstområde (kode)`: STRING, `Fangstområde (navn)`: STRING, `Fartøy ID`: STRING, Landingsdato: STRING, `Redskap (kode)`: STRING, `Rundvekt (kg)`: STRING, Seddelnummer: STRING>' AS schema
FROM (SELECT count(*) FROM landings)"""))
def src_variant_schema(spark, sf):
    return bronze.variant_schema(_bronze_landings(spark, sf))


@register("proj_pack_json", sql("""
SELECT n_nationkey, to_json({'n_nationkey': n_nationkey, 'n_name': n_name, 'n_regionkey': n_regionkey})::VARCHAR
       AS payload_json FROM nation"""))
def proj_pack_json(spark, sf):
    nation = b.Tables(spark, sf).nation
    return nation.select("n_nationkey", bronze.row_json(nation).alias("payload_json"))


@register("proj_quote_names", sql("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"))
def proj_quote_names(spark, sf):
    """Columns whose names hold spaces, dots, parentheses and backticks."""
    s = b.Tables(spark, sf).supplier
    odd = s.toDF("supplier `key`", "name (text)", "nation.key", "acct bal")
    return odd.select(quote_name("supplier `key`").alias("s_suppkey"), quote_name("name (text)").alias("s_name"),
                      quote_name("nation.key").alias("s_nationkey"), quote_name("acct bal").alias("s_acctbal"))


@register("fn_parse_json", sql("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""))
def fn_parse_json(spark, sf):
    ev = b.Tables(spark, sf).events
    return ev.select("event_id", variant_field(parse_json("props"), "k", "int").alias("k"))


@register("fn_variant_get", sql("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_long,
       json_extract_string(props, '$.k') AS k_text, CAST(NULL AS INTEGER) AS missing,
       CAST(NULL AS DATE) AS k_date
FROM events"""))
def fn_variant_get(spark, sf):
    """Typed gets: present field, as text, a missing field and a failing cast give NULL."""
    ev = b.Tables(spark, sf).events.select("event_id", parse_json("props").alias("p"))
    return ev.select("event_id", variant_field("p", "k", "bigint").alias("k_long"),
                     variant_field("p", "k", "string").alias("k_text"),
                     variant_field("p", "missing", "int").alias("missing"),
                     variant_field("p", "k", "date").alias("k_date"))


@register("fn_to_date_fmt", sql("""
SELECT note_id, CAST(try_strptime(strftime(landing_date, '%d.%m.%Y'), '%d.%m.%Y') AS DATE) AS parsed,
       CAST(NULL AS DATE) AS bad_month
FROM landings"""))
def fn_to_date_fmt(spark, sf):
    """``dd.MM.yyyy`` text to date; an impossible date gives NULL (not an error)."""
    rows = b.landings(spark, sf).select("note_id", F.date_format("landing_date", "dd.MM.yyyy").alias("t"))
    bad = F.concat(F.substring("t", 1, 3), F.lit("13"), F.substring("t", 6, 5))
    return rows.select("note_id", to_date_fmt("t").alias("parsed"), to_date_fmt(bad).alias("bad_month"))


@register("fn_to_date_iso", sql("""
SELECT date, TRY_CAST(strftime(date, '%Y-%m-%d') AS DATE) AS parsed FROM calendar"""))
def fn_to_date_iso(spark, sf):
    cal = layers.silver_calendar(spark, sf)
    return cal.select("date", to_date_iso(F.date_format("date", "yyyy-MM-dd")).alias("parsed"))


# -- tables and sinks -----------------------------------------------------------------

_TABLES: dict[tuple[str, str, str], tuple[str, str]] = {}


def _table(spark, sf: str, stem: str) -> tuple[str, str]:
    """Name and folder of a table: the same ones for all calls of an application
    on a data folder, so a second call replaces what the first has written."""
    key = (spark.sparkContext.applicationId, sf, stem)
    if key not in _TABLES:
        path = scratch_path(spark, stem)
        _TABLES[key] = f"{stem}_{path.rsplit('-', 1)[-1]}", path
    return _TABLES[key]


@register("sink_table_overwrite", sql("SELECT * FROM silver_vessels"))
def sink_table_overwrite(spark, sf):
    """Write a layer table, replace it under its name, and read it back: first
    the older register year alone, then the latest row of both."""
    name, path = _table(spark, sf, "silver_vessels")
    raw_rows = b.vessels_raw(spark, sf)
    sinks.publish_table(silver.latest_vessels(raw_rows.filter("register_year = 2024").drop("register_year")), name, path)
    sinks.publish_table(layers.silver_vessels(spark, sf), name, path)
    return sinks.read_table(spark, name)


@register("sink_partition_overwrite", sql("""
SELECT date, area_code, area_name, sea_temp_c, wave_height_m + CASE WHEN year(date) = 1996 THEN 1.0 ELSE 0.0 END AS wave_height_m,
       current_speed_ms, CAST(year(date) AS INTEGER) AS year FROM silver_sea"""))
def sink_partition_overwrite(spark, sf):
    """A table partitioned by year of which one year is replaced by corrected
    rows; the other years are not written again."""
    name, path = _table(spark, sf, "sea_by_year")
    sea = layers.shared(spark, sf).silver_sea.withColumn("year", F.year("date"))
    sinks.publish_table(sea, name, path, partition_by=["year"])
    corrected = sea.filter("year = 1996").withColumn("wave_height_m", F.col("wave_height_m") + 1.0)
    sinks.replace_partitions(corrected, name, ["year"])
    return sinks.read_table(spark, name)


@register("src_table_year", sql("SELECT date, area_code, sea_temp_c FROM silver_sea WHERE year(date) = 1997"))
def src_table_year(spark, sf):
    """One year of a partitioned table: the scan lists that partition only."""
    name, path = _table(spark, sf, "sea_of_years")
    sinks.publish_table(layers.shared(spark, sf).silver_sea.withColumn("year", F.year("date")), name, path, partition_by=["year"])
    return sinks.read_table(spark, name).filter("year = 1997").select("date", "area_code", "sea_temp_c")


@register("src_table", sql("SELECT * FROM silver_sea"))
def src_table(spark, sf):
    name, path = _table(spark, sf, "silver_sea")
    sinks.write_table(layers.silver_sea(spark, sf), name, path=path)
    return spark.read.table(name)


@register("sink_overwrite_schema", sql("SELECT * FROM week_volume"))
def sink_overwrite_schema(spark, sf):
    """Overwriting with a different schema replaces the schema."""
    from lakemart.operators import gold
    from lakemart.operators.joins import fits_broadcast
    name, path = _table(spark, sf, "gold_weekly")
    t = layers.shared(spark, sf)
    lv = gold.landings_with_vessel(t.silver_landings, t.silver_vessels, fits_broadcast(t.silver_vessels))
    sinks.publish_table(gold.week_fleet(lv), name, path)
    sinks.publish_table(gold.week_volume(lv), name, path)
    return sinks.read_table(spark, name)


@register("sink_csv", sql("SELECT * FROM silver_landings"))
def sink_csv(spark, sf):
    """``;`` CSV with header, read back with the same schema."""
    df = layers.silver_landings(spark, sf)
    path = scratch_path(spark, "sink-csv")
    sinks.write_csv(df, path, sep=";")
    return spark.read.schema(df.schema).option("header", True).option("sep", ";").csv(path)


@register("sink_jsonl", sql("SELECT * EXCLUDE (register_year) FROM vessels_raw"))
def sink_jsonl(spark, sf):
    """JSON Lines with explicit nulls, read back through Bronze."""
    df = b.vessels_raw(spark, sf).drop("register_year")
    path = scratch_path(spark, "sink-jsonl")
    sinks.write_jsonl(df, path)
    fields = [(c, t, c) for c, t in [(f.name, f.dataType.simpleString()) for f in df.schema.fields]]
    return silver.variant_select(bronze.jsonl_to_variant(spark, path), fields)


@register("sink_jsonl_nulls", sql("""
SELECT CAST(count_if(build_year IS NULL) AS BIGINT) AS null_fields FROM vessels_raw"""))
def sink_jsonl_nulls(spark, sf):
    """NULL fields are written as ``"key":null`` (one per NULL build year)."""
    df = b.vessels_raw(spark, sf).drop("register_year")
    path = scratch_path(spark, "sink-jsonl-nulls")
    sinks.write_jsonl(df, path)
    lines = spark.read.text(path)
    return lines.agg(F.count_if(F.col("value").contains('"build_year":null')).alias("null_fields"))


# -- yearly files, registers, calendar, lookups ------------------------------------------

MULTI_YEAR_REQUIRED = ("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag")


@register("src_multi_year", sql("""
SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS l_shipdate, l_returnflag,
       CAST(year(l_shipdate) AS INTEGER) AS source_year FROM lineitem"""))
def src_multi_year(spark, sf):
    """One ``;`` CSV folder per year, column contract checked, unioned, typed."""
    lines = files.read_years(spark, raw.lineitem_years(spark, sf), MULTI_YEAR_REQUIRED)
    return lines.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.col("l_quantity").cast("double").alias("l_quantity"),
        F.to_date(F.substring("l_shipdate", 1, 10)).alias("l_shipdate"),
        "l_returnflag",
        F.col("source_year").cast("int").alias("source_year"),
    )


@register("set_union_years", sql("""
SELECT CAST(year(l_shipdate) AS INTEGER) AS source_year, CAST(count(*) AS BIGINT) AS rows
FROM lineitem GROUP BY 1"""))
def set_union_years(spark, sf):
    lines = files.read_years(spark, raw.lineitem_years(spark, sf), MULTI_YEAR_REQUIRED)
    return lines.groupBy(F.col("source_year").cast("int").alias("source_year")).agg(F.count(F.lit(1)).alias("rows"))


REGISTER_COLUMNS = {"vessel_id": ["Fartøy ID"], "width": ["Bredde"]}
_REGISTER_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS vessel_id,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(5.0 + s_suppkey % 7 AS VARCHAR) END AS width,
       2025 AS register_year FROM supplier
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), CAST(4.5 + s_suppkey % 5 AS VARCHAR), 2024 FROM supplier"""


@register("src_register_union", sql(_REGISTER_SQL))
def src_register_union(spark, sf):
    """Yearly registers with differently spelled headers, tagged and unioned."""
    return files.register_union(raw.width_registers(spark, sf), REGISTER_COLUMNS)


@register("src_calendar", sql("SELECT * FROM calendar"))
def src_calendar(spark, sf):
    return b.calendar_table(spark, sf)


LOOKUP_NAMES = {"ECONOMY": "Economy", "LARGE": "Large", "MEDIUM": "Medium", "PROMO": "Promo",
                "SMALL": "Small", "STANDARD": "Standard"}


@register("src_lookup", sql("""
SELECT l.note_id, l.species_code,
       CASE l.species_code WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large' WHEN 'MEDIUM' THEN 'Medium'
            WHEN 'PROMO' THEN 'Promo' WHEN 'SMALL' THEN 'Small' WHEN 'STANDARD' THEN 'Standard' END AS label
FROM silver_landings l"""))
def src_lookup(spark, sf):
    """Constant code -> label map joined as a broadcast (size fixed in code)."""
    table = lookup(spark, LOOKUP_NAMES, "species_code", "label")
    return (layers.silver_landings(spark, sf).select("note_id", "species_code")
            .join(F.broadcast(table), "species_code", "left"))


@register("join_lookup_default", sql("""
SELECT l.note_id,
       coalesce(CASE WHEN l.gear_code = 'R' THEN NULL ELSE l.species_name END,
                CASE l.species_code WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large'
                     WHEN 'MEDIUM' THEN 'Medium' WHEN 'PROMO' THEN 'Promo' WHEN 'SMALL' THEN 'Small'
                     WHEN 'STANDARD' THEN 'Standard' END) AS species_name
FROM silver_landings l"""))
def join_lookup_default(spark, sf):
    """Name from the row, or the lookup name when the row has none."""
    table = lookup(spark, LOOKUP_NAMES, "species_code", "label")
    rows = layers.silver_landings(spark, sf).withColumn(
        "species_name", F.when(F.col("gear_code") == "R", F.lit(None).cast("string")).otherwise(F.col("species_name")))
    return (rows.join(F.broadcast(table), "species_code", "left")
            .select("note_id", F.coalesce("species_name", "label").alias("species_name")))


@register("stream_bronze_ingest", sql("SELECT * FROM landings"))
def stream_bronze_ingest(spark, sf):
    """Landed files taken incrementally (Structured Streaming, availableNow)
    into a Bronze folder, then typed: equal to the source rows."""
    from lakemart.streaming import append_new_files, csv_stream_to_variant
    from lakemart.sources.files import read_csv_strings

    landing = raw.landings_csv(spark, sf)
    columns = read_csv_strings(spark, landing, ";").columns
    target = scratch_path(spark, "bronze-landings")
    append_new_files(csv_stream_to_variant(spark, landing, columns, ";"), target)
    return silver.parse_landings(spark.read.parquet(target)).drop("_ingest_ts")
