"""Raw source files derived from the bound tables, in the sources' own layouts.

Each call writes a fresh folder below the shared checkpoint folder and
returns its path, so Bronze ingest, yearly reads and sinks run on real files
whose size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import extract as ex
from lakemart.operators.joins import broadcast_if_fits
from lakemart.plans import bindings as b
from lakemart.session import scratch_path
from lakemart.sources.sinks import write_csv, write_jsonl


def _out(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def landings_frame(spark: SparkSession, sf: str) -> DataFrame:
    """LANDINGS in the landings file layout (``;`` CSV, day-first dates)."""
    rows = b.landings(spark, sf)
    return rows.select(
        F.col("note_id").alias("Seddelnummer"),
        F.date_format("landing_date", "dd.MM.yyyy").alias("Landingsdato"),
        F.col("vessel_id").alias("Fartøy ID"),
        F.col("species_code").alias("Art FAO (kode)"),
        F.col("species_name").alias("Art FAO (navn)"),
        F.col("area_code").alias("Fangstområde (kode)"),
        F.col("area_name").alias("Fangstområde (navn)"),
        F.col("gear_code").alias("Redskap (kode)"),
        F.col("weight_kg").alias("Rundvekt (kg)"),
    )


def landings_csv(spark: SparkSession, sf: str) -> str:
    path = _out(spark, "landings-csv")
    write_csv(landings_frame(spark, sf), path, sep=";")
    return path


def landings_csv_by_year(spark: SparkSession, sf: str) -> str:
    """The landings file layout, one folder a landing year (rows without a date
    are in no year's file)."""
    path = _out(spark, "landings-csv-years")
    rows = landings_frame(spark, sf).withColumn("year", F.substring("Landingsdato", 7, 4)).filter("year is not null")
    rows.write.partitionBy("year").option("header", True).option("sep", ";").option("encoding", "UTF-8").csv(path)
    return path


def vessels_csv(spark: SparkSession, sf: str) -> str:
    """VESSELS (both register years); build year written float-like (``1999.0``)."""
    v = b.vessels_raw(spark, sf)
    out = v.select(
        F.col("vessel_id").alias("Fartøy ID"),
        F.col("registration").alias("Registreringsmerke"),
        F.col("vessel_name").alias("Fartøynavn"),
        F.col("vessel_type").alias("Fartøytype"),
        F.col("vessel_group").alias("Fartøygruppe"),
        F.col("length_m").alias("Lengde (meter)"),
        F.col("length_group").alias("Lengdegruppe"),
        F.col("width_m").alias("Bredde (meter)"),
        F.col("gross_tonnage").alias("Bruttotonnasje"),
        F.col("build_year").cast("double").alias("Byggeår"),
        F.col("power_kw").alias("Motorkraft (kW)"),
        F.col("home_municipality").alias("Hjemkommune"),
        F.col("nationality").alias("Nasjonalitet"),
    )
    path = _out(spark, "vessels-csv")
    write_csv(out, path, sep=",")
    return path


def sea_jsonl(spark: SparkSession, sf: str) -> str:
    s = b.sea_raw(spark, sf)
    out = s.select(
        F.date_format("date", "yyyy-MM-dd").alias("dato"),
        F.col("area_code").alias("fangstomrade_kode"),
        F.col("area_name").alias("fangstomrade_navn"),
        F.col("sea_temp_c").alias("havtemperatur_c"),
        F.col("wave_height_m").alias("bolgehoyde_m"),
        F.col("current_speed_ms").alias("stromhastighet_ms"),
    )
    path = _out(spark, "sea-jsonl")
    write_jsonl(out, path)
    return path


def _bool_text(c: str):
    return F.when(F.col(c), "True").otherwise("False")


def calendar_csv(spark: SparkSession, sf_dir: str) -> str:
    """The calendar in the course file layout (booleans as ``True``/``False``)."""
    cal = b.calendar_table(spark, sf_dir)
    out = cal.select(
        F.date_format("date", "yyyy-MM-dd").alias("dato"),
        F.date_format("week_start", "yyyy-MM-dd").alias("uke_start"),
        F.col("year").alias("aar"),
        F.col("month").alias("maaned"),
        F.col("iso_week").alias("ukenummer"),
        F.col("weekday").alias("ukedag"),
        _bool_text("is_weekend").alias("er_helg"),
        _bool_text("is_holiday").alias("er_helligdag"),
        F.col("season").alias("sesong"),
    )
    path = _out(spark, "calendar-csv")
    write_csv(out, path, sep=",")
    return path


def list_partitions(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """``{value: folder}`` of a ``column=value`` partitioned folder (metadata only)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{column}="):
            out[name.split("=", 1)[1]] = status.getPath().toString()
    return out


def hourly_jsonl(spark: SparkSession, sf: str) -> str:
    """The hourly replies as JSON Lines, one reply a line."""
    path = _out(spark, "hourly-jsonl")
    write_jsonl(b.hourly_replies(spark, sf), path)
    return path


def lineitem_years(spark: SparkSession, sf: str) -> dict[int, str]:
    """lineitem as one ``;`` CSV folder per ship year. Each folder holds files of
    two headers: odd lines have the columns in reverse order."""
    li = b.Tables(spark, sf).lineitem.withColumn("ship_year", F.year("l_shipdate"))
    path = _out(spark, "lineitem-years")
    for part, columns in ((0, li.columns), (1, li.columns[::-1])):
        (li.filter(F.col("l_linenumber") % 2 == part).select(*columns).write.mode("append").partitionBy("ship_year")
         .option("header", True).option("sep", ";").csv(path))
    return {int(k): v for k, v in list_partitions(spark, path, "ship_year").items()}


def catch_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Catch lines (all text) in the source layout of the yearly catch files.

    Codes, numbers and dates are written the way the source writes them:
    species code with a trailing blank, area code as ``3.0``, weights with a
    decimal comma, build year float-like, blank vessel ids.
    """
    t = b.Tables(spark, sf)
    nr = (t.nation.join(broadcast_if_fits(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
          .select("n_nationkey", "n_name", "n_regionkey", "r_name"))
    suppliers = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    sup = broadcast_if_fits(
        suppliers.join(broadcast_if_fits(nr, bound=t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "n_name", "n_regionkey", "r_name"),
        bound=suppliers)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    j = (li.join(broadcast_if_fits(t.part.select("p_partkey", "p_type")), F.col("l_partkey") == F.col("p_partkey"))
         .join(sup, F.col("l_suppkey") == F.col("s_suppkey")))
    length = (F.lit(10) + F.col("s_suppkey") % 30).cast("double")
    comma = lambda c: F.replace(c.cast("string"), F.lit("."), F.lit(","))
    return j.select(
        F.col("l_orderkey").cast("string").alias(ex.DOC),
        F.col("l_returnflag").alias(ex.SALES_ORG),
        F.col("l_linenumber").cast("string").alias(ex.LINE),
        F.date_format("l_shipdate", "dd.MM.yyyy").alias(ex.DATE),
        F.when(F.col("l_tax") == F.lit(b.NULL_VESSEL_TAX), F.lit(""))
         .otherwise(F.col("l_suppkey").cast("string")).alias(ex.VESSEL),
        F.concat(F.lit("R-"), F.col("l_suppkey").cast("string")).alias("Registreringsmerke (seddel)"),
        F.col("s_name").alias("Fartøynavn"),
        F.col("n_name").alias("Fartøytype"),
        F.col("n_name").alias("Fartøykommune"),
        F.col("r_name").alias("Fartøynasjonalitet"),
        F.when(F.col("l_linenumber") == 1, F.lit(None).cast("string")).otherwise(comma(length)).alias("Største lengde"),
        F.concat((F.floor(length / 5) * 5).cast("int").cast("string"), F.lit("m+")).alias("Lengdegruppe"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit(None).cast("string"))
         .otherwise((F.col("s_nationkey") * 10).cast("string")).alias("Bruttotonnasje 1969"),
        (F.col("s_nationkey") * 7).cast("string").alias("Bruttotonnasje annen"),
        (F.lit(1960) + F.col("s_suppkey") % 60).cast("double").cast("string").alias("Byggeår"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("string"))
         .otherwise(comma(F.col("s_acctbal"))).alias("Motorkraft"),
        F.concat(F.col("p_type"), F.lit(" ")).alias(ex.SPECIES),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
         .otherwise(F.lower("p_type")).alias(ex.SPECIES_NAME),
        F.concat(F.col("n_regionkey").cast("string"), F.lit(".0")).alias(ex.AREA),
        F.col("r_name").alias(ex.AREA_NAME),
        F.col("l_linestatus").alias(ex.GEAR),
        F.when(F.col("l_discount") == F.lit(b.NULL_WEIGHT_DISCOUNT), F.lit(None).cast("string"))
         .otherwise(comma(F.col("l_quantity"))).alias(ex.WEIGHT),
    )


def width_registers(spark: SparkSession, sf: str) -> dict[int, DataFrame]:
    """Two register years with differently spelled headers and gaps."""
    s = b.Tables(spark, sf).supplier
    newer = s.select(
        F.col("s_suppkey").cast("string").alias("Fartøy ID "),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit(None).cast("string"))
         .otherwise((F.lit(5.0) + F.col("s_suppkey") % 7).cast("string")).alias(" Bredde"),
    )
    older = s.select(
        F.col("s_suppkey").cast("string").alias("FARTØY ID"),
        (F.lit(4.5) + F.col("s_suppkey") % 5).cast("string").alias("bredde"),
    )
    return {2025: newer, 2024: older}


# Extract parameters for the bound data: the mapped species and three areas.
EXTRACT_SPECIES = tuple(b.BOUND_SPECIES_IDS)
EXTRACT_AREAS = ("01", "02", "03")
EXTRACT_NAMES = {code: code.title() for code in EXTRACT_SPECIES}
