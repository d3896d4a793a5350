"""Bindings of the layer operators to the benchmark tables.

The driver tables stand in for the four raw sources:

* LANDINGS  lineitem joined to part, supplier, nation, region: one row per
            landing line as typed after Bronze (before any cleaning).
* VESSELS   supplier joined to nation, twice (two register years) so the
            latest-row choice has real duplicates, ties and NULL build years.
* SEA       orders joined to customer, nation, region: several readings per
            (date, area), cleaned by a deterministic dedup.
* CALENDAR  generated for the years the data covers.
* HOURLY    events packed into bounded 24-reading replies of parallel arrays.

Every dimension, nation and region included, is broadcast only behind a check
of its size; beyond it the join is a shuffle join, which AQE may still turn into
a broadcast after it has measured the side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import lpad_code, vessel_group
from lakemart.operators.joins import broadcast_if_fits, fits_broadcast
from lakemart.sources.calendar import calendar_of

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Binding constants: which driver values play the invalid rows of the source.
NULL_VESSEL_TAX = 0.08          # l_tax = 0.08 -> vessel id missing
NULL_WEIGHT_DISCOUNT = 0.0      # l_discount = 0 -> weight missing
# Species ids for the bound species codes (p_type); the rest get 99.
BOUND_SPECIES_IDS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3}
# Holdout for the bound data (sea readings end 2001-08-01).
TRAIN_LAST_TARGET_WEEK = "2001-06-25"
TEST_YEAR = 2001
TEST_MONTH = 7
HOURLY_REPLY_SIZE = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def _nation_region(t: Tables) -> DataFrame:
    return (t.nation.join(broadcast_if_fits(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", "n_name", "n_regionkey", "r_name"))


def _supplier_area(t: Tables, suppliers: DataFrame) -> DataFrame:
    return (suppliers
            .join(broadcast_if_fits(_nation_region(t), bound=t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "n_regionkey", "r_name"))


def _vessel_id() -> Column:
    return (F.when(F.col("l_tax") == F.lit(NULL_VESSEL_TAX), F.lit(None).cast("string"))
            .otherwise(F.col("l_suppkey").cast("string")).alias("vessel_id"))


def _weight_kg() -> Column:
    return (F.when(F.col("l_discount") == F.lit(NULL_WEIGHT_DISCOUNT), F.lit(None).cast("double"))
            .otherwise(F.col("l_quantity")).alias("weight_kg"))


def landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LANDINGS: typed landing lines before cleaning (Silver's parsed stage)."""
    t = Tables(spark, sf_dir)
    suppliers = t.supplier.select("s_suppkey", "s_nationkey")
    supplier_area = _supplier_area(t, suppliers)
    parts = t.part.select("p_partkey", "p_type")
    li = t.lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("note_id"),
        "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    # note_id is the key Silver deduplicates on: the window reuses this partitioning.
    return (li.join(broadcast_if_fits(parts), F.col("l_partkey") == F.col("p_partkey"))
            .join(broadcast_if_fits(supplier_area, bound=suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                "note_id",
                F.col("l_shipdate").cast("date").alias("landing_date"),
                _vessel_id(),
                F.col("p_type").alias("species_code"),
                F.lower("p_type").alias("species_name"),
                F.col("n_regionkey").cast("string").alias("area_code"),
                F.col("r_name").alias("area_name"),
                F.col("l_returnflag").alias("gear_code"),
                _weight_kg(),
            ))


def landing_vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vessel id of every line: what the layout of the vessels is chosen by."""
    return Tables(spark, sf_dir).lineitem.select(_vessel_id())


def vessel_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The areas of each vessel: one, unless a key of its dimensions repeats."""
    t = Tables(spark, sf_dir)
    return (_supplier_area(t, t.supplier.select("s_suppkey", "s_nationkey"))
            .select(F.col("s_suppkey").cast("string").alias("vessel_id"), F.col("n_regionkey").cast("string").alias("area_code"),
                    F.col("r_name").alias("area_name")))


def odd_suppliers(spark: SparkSession, sf_dir: str, areas: DataFrame) -> DataFrame:
    """Suppliers of lines that have no area or several (``n_areas``): as a rule none."""
    used = Tables(spark, sf_dir).lineitem.select("l_suppkey").filter("l_suppkey is not null").distinct()
    counts = areas.groupBy(F.col("vessel_id").cast("long").alias("l_suppkey")).agg(F.count(F.lit(1)).alias("n_areas"))
    return (used.join(counts, "l_suppkey", "left").select("l_suppkey", F.coalesce("n_areas", F.lit(0)).alias("n_areas"))
            .filter("n_areas <> 1"))


def landing_lines(spark: SparkSession, sf_dir: str, odd: DataFrame) -> DataFrame:
    """LANDINGS without the area, which is looked up by vessel after cleaning.
    Each line stands for ``n_areas`` rows of ``landings``: lines with none are
    left out, and only the written table ``odd`` (of ``odd_suppliers``) is joined
    to know that. Its name is one of the code (``landing_columns``). The columns
    are typed before the join with the parts, which hashes a share of the parts in
    each task: the lines are shuffled narrow and are not sorted for it."""
    t = Tables(spark, sf_dir)
    lines = t.lineitem.filter("l_suppkey is not null").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("note_id"),
        "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("landing_date"), _vessel_id(),
        F.col("l_returnflag").alias("gear_code"), _weight_kg())
    with_area = (lines.join(broadcast_if_fits(odd), "l_suppkey", "left")
                 .withColumn("n_areas", F.coalesce("n_areas", F.lit(1))).filter("n_areas > 0").drop("l_suppkey"))
    parts = t.part.select("p_partkey", "p_type")
    parts = F.broadcast(parts) if fits_broadcast(parts) else parts.hint("shuffle_hash")
    return (with_area.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select("note_id", "landing_date", "vessel_id", F.col("p_type").alias("species_code"), "gear_code", "weight_kg", "n_areas"))


def landing_columns() -> list[Column]:
    """Silver's landing columns from cleaned ``landing_lines`` and their areas."""
    return [F.col("note_id"), F.col("landing_date"), F.col("vessel_id"), F.col("species_code"), F.lower("species_code").alias("species_name"),
            F.col("area_code"), F.col("area_name"), F.col("gear_code"), F.col("weight_kg")]


def _vessel_rows(t: Tables, build_year: Column, power: Column, register_year: int) -> DataFrame:
    length = (F.lit(10) + F.col("s_suppkey") % 30).cast("double")
    return (t.supplier.join(broadcast_if_fits(_nation_region(t), bound=t.nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").cast("string").alias("vessel_id"),
                F.concat(F.lit("R-"), F.col("s_suppkey").cast("string")).alias("registration"),
                F.col("s_name").alias("vessel_name"),
                F.col("n_name").alias("vessel_type"),
                vessel_group(length).alias("vessel_group"),
                length.alias("length_m"),
                F.concat((F.floor(length / 5) * 5).cast("int").cast("string"), F.lit("m+")).alias("length_group"),
                (length / F.lit(4.0)).alias("width_m"),
                (F.col("s_nationkey") * 10).cast("double").alias("gross_tonnage"),
                build_year.cast("int").alias("build_year"),
                power.alias("power_kw"),
                F.col("n_name").alias("home_municipality"),
                F.col("r_name").alias("nationality"),
                F.lit(register_year).alias("register_year"),
            ))


def vessels_fit_broadcast(spark: SparkSession, sf_dir: str) -> bool:
    """Whether vessel tables (at most two rows per supplier) may be broadcast."""
    from lakemart.operators.joins import DEFAULT_EXPANSION, fits_broadcast
    return fits_broadcast(Tables(spark, sf_dir).supplier, expansion=2 * DEFAULT_EXPANSION)


def vessels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VESSELS twice: two register years of every vessel.

    The older copy has an equal, older or missing build year in turn, so the
    latest-row rule meets ties and NULLs.
    """
    t = Tables(spark, sf_dir)
    year = F.lit(1960) + F.col("s_suppkey") % 60
    newer = _vessel_rows(t, year, F.col("s_acctbal"), 2025)
    phase = F.col("s_suppkey") % 4
    older_year = (F.when(phase == 0, F.lit(None)).when(phase == 1, year).otherwise(year - 1))
    older = _vessel_rows(t, older_year, F.col("s_acctbal") + F.lit(1.0), 2024)
    return newer.unionByName(older)


def sea_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SEA: one reading per order, several per (date, area), area code unpadded."""
    t = Tables(spark, sf_dir)
    customers = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    cust_area = (customers
                 .join(broadcast_if_fits(_nation_region(t), bound=t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
                 .select("c_custkey", "c_acctbal", "n_regionkey", "r_name"))
    orders = t.orders.select(F.col("o_orderdate").cast("date").alias("date"), "o_custkey", "o_totalprice")
    # date is part of Silver's (date, area) dedup key: the window reuses this partitioning.
    return (orders
            .join(broadcast_if_fits(cust_area, bound=customers), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                "date",
                F.col("n_regionkey").cast("string").alias("area_code"),
                F.col("r_name").alias("area_name"),
                F.col("c_acctbal").alias("sea_temp_c"),
                F.col("o_totalprice").alias("wave_height_m"),
                F.col("o_custkey").cast("double").alias("current_speed_ms"),
            ))


def calendar_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over all landing and sea dates of the given tables."""
    t = Tables(spark, sf_dir)
    return calendar_of(t.lineitem.select(F.col("l_shipdate").cast("date").alias("date"))
                       .unionByName(t.orders.select(F.col("o_orderdate").cast("date").alias("date"))))


def hourly_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HOURLY: events packed into replies of at most 24 readings, each reply a
    struct of parallel arrays like a marine weather API answer.

    Group size is bounded by construction (event ids are unique), so
    ``collect_list`` never gathers an unbounded group.
    """
    t = Tables(spark, sf_dir)
    ev = t.events.select(
        "event_id", "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("user_id").cast("double").alias("user"),
    )
    packed = (ev.groupBy("event_type", F.floor(F.col("event_id") / HOURLY_REPLY_SIZE).alias("reply_id"))
              .agg(F.array_sort(F.collect_list(F.struct("event_id", "ts", "value", "k", "user"))).alias("r")))
    return packed.select(
        "event_type", "reply_id",
        F.struct(
            F.transform("r", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("time"),
            F.transform("r", lambda x: x["value"]).alias("sea_surface_temperature"),
            F.transform("r", lambda x: x["k"]).alias("wave_height"),
            F.transform("r", lambda x: x["user"]).alias("ocean_current_velocity"),
        ).alias("hourly"),
    )


def area_code_padded(c: str = "area_code") -> Column:
    return lpad_code(c, 2)
