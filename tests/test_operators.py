"""Unit tests on hand-made frames: the semantic traps of the source pipeline."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart import functions as fn
from lakemart.operators import extract as ex
from lakemart.operators import features as feat
from lakemart.operators import gold, metrics, silver
from lakemart.sources import calendar as cal
from lakemart.sources import files
from tests.conftest import SF_SMALL

D = dt.date
LANDING_SCHEMA = ("note_id string, landing_date date, vessel_id string, species_code string, "
                  "species_name string, area_code string, area_name string, gear_code string, weight_kg double")


def landings(spark, rows):
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def test_dedup_runs_before_filters_and_prefer_valid(spark):
    rows = [("n1", D(2024, 3, 4), "v1", "COD", "Torsk", "3", "A", "G", 0.0),
            ("n1", D(2024, 3, 4), "v1", "COD", "Torsk", "3", "A", "G", 5.0),
            ("n2", D(2024, 3, 4), "v1", "COD", "Torsk", "3", "A", "G", None),
            ("n2", D(2024, 3, 4), "v1", "COD", "Torsk", "3", "A", "G", 7.0)]
    df = landings(spark, rows)
    plain = {r.note_id: r.weight_kg for r in silver.clean_landings(df).collect()}
    # n1: the 0 kg row sorts first and is dropped by the filter afterwards (dedup first).
    # n2: NULL weights sort last, so the 7 kg row is kept.
    assert plain == {"n2": 7.0}
    valid = {r.note_id: r.weight_kg for r in silver.clean_landings(df, prefer_valid=True).collect()}
    assert valid == {"n1": 5.0, "n2": 7.0}


def test_dedup_is_deterministic_across_partitionings(spark):
    rows = [(f"n{i % 7}", D(2024, 1, 1 + i % 20), f"v{i % 3}", "COD", "Torsk", "3", "A", "G", float(i))
            for i in range(200)]
    a = silver.dedup_notes(landings(spark, rows).repartition(1)).collect()
    b = silver.dedup_notes(landings(spark, rows).repartition(13)).collect()
    assert sorted(a) == sorted(b)


def test_area_code_padded_and_keys_required(spark):
    rows = [("a", D(2024, 3, 4), "v", "COD", "Torsk", "3", "A", "G", 1.0),
            ("b", None, "v", "COD", "Torsk", "3", "A", "G", 1.0),
            ("c", D(2024, 3, 4), None, "COD", "Torsk", "3", "A", "G", 1.0),
            ("d", D(2024, 3, 4), "v", "COD", "Torsk", "123", "A", "G", 1.0)]
    out = {r.note_id: r.area_code for r in silver.clean_landings(landings(spark, rows)).collect()}
    assert out == {"a": "03", "d": "12"}


def test_tolerant_dates_under_ansi(spark):
    df = spark.createDataFrame([("31.13.2024",), ("",), ("15.03.2024",), (None,)], "t string")
    got = [r.d for r in df.select(fn.to_date_fmt("t").alias("d")).collect()]
    assert got == [None, None, D(2024, 3, 15), None]
    got = [r.d for r in df.select(fn.to_date_dayfirst("t").alias("d")).collect()]
    assert got == [None, None, D(2024, 3, 15), None]


def test_norwegian_numbers(spark):
    df = spark.createDataFrame([("12,5",), ("1 234,5",), ("1 234",), ("abc",), ("",), ("-3",), (None,)], "t string")
    got = [r.x for r in df.select(fn.to_number("t").alias("x")).collect()]
    assert got == [12.5, 1234.5, 1234.0, None, None, -3.0, None]


def test_padding_cutting_and_dot_zero(spark):
    df = spark.createDataFrame([("3",), ("03",), ("123",), ("3.0",), ("1.05",), ("0A",)], "c string")
    rows = df.select(fn.lpad_code("c").alias("lp"), fn.zfill_code("c").alias("zf"),
                     fn.strip_dot0("c").alias("st"), fn.area_id("c").alias("id")).collect()
    assert [r.lp for r in rows] == ["03", "03", "12", "3.", "1.", "0A"]
    assert [r.zf for r in rows] == ["03", "03", "123", "3.0", "1.05", "0A"]
    assert [r.st for r in rows] == ["3", "03", "123", "3", "1.05", "0A"]
    assert [r.id for r in rows] == [3, 3, 123, None, None, None]


def test_latest_vessel_tie_break_and_float_year(spark):
    from lakemart.sources import bronze
    schema = "vessel_id string, name string, build_year int"
    df = spark.createDataFrame([("v1", "b", 1999), ("v1", "a", 1999), ("v2", "x", None), ("v2", "y", 1980),
                                (None, "z", 2020)], schema)
    out = {r.vessel_id: r.name for r in silver.latest_vessels(df).collect()}
    assert out == {"v1": "a", "v2": "y"}
    text = spark.createDataFrame([('{"Byggeår": "1999.0"}',)], "j string")
    parsed = silver.parse_vessels(text.select(fn.parse_json("j").alias("payload")))
    assert parsed.first().build_year == 1999
    assert bronze.BRONZE_COLUMNS == ("payload", "_ingest_ts", "_source_file")


def test_vessel_group_bins_right_closed(spark):
    df = spark.createDataFrame([(20.0,), (20.1,), (30.0,), (31.0,), (None,)], "l double")
    assert [r.g for r in df.select(fn.vessel_group("l").alias("g")).collect()] == \
        ["Kyst", "Kyst større", "Kyst større", "Hav", None]


def test_reference_calendar_facts(spark):
    c = cal.calendar(spark)
    assert c.count() == 399
    assert c.select("week_start").distinct().count() == 57
    assert c.filter("is_weekend").count() == 114
    assert c.filter("is_holiday").count() == 11
    seasons = {r.season: r["count"] for r in c.groupBy("season").count().collect()}
    assert seasons == {"vinter": 124, "vaar": 92, "sommer": 92, "hoest": 91}
    row = c.filter(F.col("date") == F.lit("2024-12-30").cast("date")).first()
    assert (row.iso_week, row.month, row.weekday) == (1, 12, 1)
    first = c.filter(F.col("date") == F.lit("2024-01-06").cast("date")).first()
    assert (first.week_start, first.weekday, first.is_weekend) == (D(2024, 1, 1), 6, True)


def test_metrics_zero_actuals_give_null_not_error(spark):
    pred = spark.createDataFrame([("Torsk", 0.0, 1.0), ("Torsk", 0.0, 2.0)],
                                 "species_name string, target_kg double, predicted_kg double")
    row = metrics.overall(pred).first()
    assert row.mae == 1.5 and row.wmape is None
    sp = metrics.by_species(pred).first()
    assert sp.deviation_pct is None and sp.deviation_kg == 3.0


def test_latest_non_null_takes_older_value_when_newest_missing(spark):
    df = spark.createDataFrame([("v1", D(2024, 1, 2), "d", "1", None), ("v1", D(2024, 1, 1), "d", "1", "old")],
                               "vessel_id string, landing_date date, Dokumentnummer string, Linjenummer string, x string")
    out = ex.latest_non_null(df, "vessel_id", ["x"], ["landing_date", "Dokumentnummer", "Linjenummer"]).first()
    assert out.x == "old"


def test_fleet_counts_each_vessel_once_and_null_name_grain(spark):
    lv = spark.createDataFrame([
        ("n1", D(2024, 1, 1), "v1", "COD", "Torsk", "03", "A", 10.0, 12.0, 100.0),
        ("n2", D(2024, 1, 2), "v1", "COD", "Torsk", "03", "A", 5.0, 12.0, 100.0),
        ("n3", D(2024, 1, 2), "v2", "COD", "Torsk", "03", "A", 1.0, 20.0, 300.0),
        ("n4", D(2024, 1, 2), "v2", "COD", None, "03", "A", 2.0, 20.0, 300.0),
    ], "note_id string, landing_date date, vessel_id string, species_code string, species_name string, "
       "area_code string, area_name string, weight_kg double, length_m double, power_kw double")
    lv = lv.withColumn("week_start", fn.week_start("landing_date"))
    fused = {(r.species_name,): r for r in gold.week_volume_fleet(lv).collect()}
    joined = {(r.species_name,): r for r in gold.week_volume(lv).join(gold.week_fleet(lv), gold.WEEK_GRAIN, "left")
              .collect()}
    assert fused.keys() == joined.keys()
    for k in fused:
        assert fused[k].asDict() == joined[k].asDict()
    torsk = fused[("Torsk",)]
    assert (torsk.landed_kg, torsk.n_notes, torsk.active_vessels, torsk.avg_length_m) == (16.0, 3, 2, 16.0)
    assert fused[(None,)].active_vessels is None  # NULL grain never joins, as in the reference


def test_dense_weeks_and_row_lags(spark):
    mart = spark.createDataFrame([("C", "03", D(2024, 1, 1), 1.0), ("C", "03", D(2024, 1, 15), 3.0)],
                                 "species_code string, area_code string, week_start date, landed_kg double")
    rows = feat.add_lags(mart).orderBy("week_start").collect()
    assert rows[1].lag_1 == 1.0  # lags count rows: the missing week is skipped
    dense = feat.add_lags(feat.dense_weeks(mart)).orderBy("week_start").collect()
    assert [r.landed_kg for r in dense] == [1.0, 0.0, 3.0]
    assert dense[2].lag_1 == 0.0


def test_features_do_not_leak_future_weeks(spark):
    from lakemart.plans import layers
    mart = layers.mart(spark, SF_SMALL)
    cut = D(1999, 1, 4)
    cols = ["species_code", "area_code", "week_start", "lag_1", "lag_4", "mean_4"]
    full = feat.feature_mart(mart).filter(F.col("week_start") < F.lit(cut)).select(*cols)
    early = feat.feature_mart(mart.filter(F.col("week_start") < F.lit(cut))).select(*cols)
    assert full.exceptAll(early).count() == 0 and early.exceptAll(full).count() == 0


def test_mart_totals_and_fact_rows(spark):
    from lakemart.plans import layers
    landings = layers.silver_landings(spark, SF_SMALL)
    mart = layers.mart(spark, SF_SMALL)
    assert mart.agg(F.sum("landed_kg")).first()[0] == landings.agg(F.sum("weight_kg")).first()[0]
    assert mart.groupBy(*gold.WEEK_GRAIN).count().filter("count > 1").count() == 0
    from lakemart.plans.catalog import QUERIES
    assert QUERIES["fact_landings"](spark, SF_SMALL).count() == landings.count()


def test_schema_drift_and_register_names(spark, tmp_path):
    path = str(tmp_path / "y2024")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", True).option("sep", ";").csv(path)
    with pytest.raises(files.SchemaDriftError):
        files.read_years(spark, {2024: path}, ["a", "c"])
    ok = files.read_years(spark, {2024: path}, ["a"])
    assert ok.columns == ["a", "source_year"]
    reg = {2025: spark.createDataFrame([("1", "5")], "`Fartøy ID ` string, ` BREDDE` string"),
           2024: spark.createDataFrame([("1", "4")], "`fartøy id` string, bredde string")}
    out = files.register_union(reg, {"vessel_id": ["Fartøy ID"], "width": ["Bredde"]})
    assert sorted((r.register_year, r.width) for r in out.collect()) == [(2024, "4"), (2025, "5")]
    assert ex.width_by_vessel(out).first().width_m == 5.0
    with pytest.raises(files.SchemaDriftError):
        files.register_union(reg, {"vessel_id": ["Fartøy ID"], "width": ["Bredde"], "gt": ["Tonnasje"]})


def test_round_mean_half_up_on_exact_value(spark):
    df = spark.createDataFrame([("d", 0.28), ("d", 0.29)], "k string, x double")
    out = df.groupBy("k").agg(ex.round_mean("x", 2).alias("m"), ex.round_mean("x", 3, divisor=3.6).alias("ms"))
    row = out.first()
    assert row.m == 0.29  # 0.285 exactly -> half-up
    assert row.ms == 0.079  # 0.285 / 3.6 = 0.0791666...


def test_sample_keeps_eight_valid_and_one_invalid(spark):
    rows = [(str(i), "S", "1", "01.01.2024", "v" if i % 3 else "", "COD", "03", f"{i},0") for i in range(1, 21)]
    df = spark.createDataFrame(rows, "`Dokumentnummer` string, `Salgslag (kode)` string, `Linjenummer` string, "
                                     "`Landingsdato` string, `Fartøy ID` string, `Art FAO (kode)` string, "
                                     "`Hovedområde (kode)` string, `Rundvekt` string")
    sel = ex.select_catch(df, ["COD"], ["03"], "2024-01-01", "2024-12-31")
    sample = ex.sample_lines(sel).collect()
    valid = sorted(int(r.Dokumentnummer) for r in sample if r._valid)
    invalid = [int(r.Dokumentnummer) for r in sample if not r._valid]
    assert valid == [1, 10, 11, 13, 14, 16, 17, 19]  # text order of document numbers
    assert invalid == [12]


def test_forest_repeats_and_keeps_layout(spark):
    """The training layout is fixed: shuffled input gives the same model."""
    from lakemart.operators import forecast as fc
    rows = [(f"S{i % 3}", "n", f"{i % 5:02d}", "a", D(2024, 1, 1 + i % 28), float(i % 7), float((i * 37) % 11)) for i in range(280)]
    schema = "species_code string, species_name string, area_code string, area_name string, week_start date, x double, target_kg double"
    df = spark.createDataFrame(rows, schema).dropDuplicates(["species_code", "area_code", "week_start"])
    params = fc.ForestParams(num_trees=8, max_depth=4)
    predicted = []
    for shuffled in (df.repartition(1), df.repartition(7), df.orderBy("x")):
        model = fc.fit(shuffled, ["x"], params)
        predicted.append([r.predicted_kg for r in model.transform(df.orderBy("species_code", "area_code", "week_start")).orderBy("species_code", "area_code", "week_start").collect()])
    assert predicted[0] == predicted[1] == predicted[2]


def test_two_names_for_one_code_in_any_order(spark):
    rows = [("A", n, "03", "x", D(2024, 1, d), kg) for n, d, kg in (("one", 1, 1.0), ("two", 1, 2.0), ("one", 8, 3.0), ("two", 8, 4.0))]
    schema = "species_code string, species_name string, area_code string, area_name string, week_start date, landed_kg double"
    found = [sorted(map(str, feat.add_lags(spark.createDataFrame(r, schema).coalesce(1)).collect())) for r in (rows, rows[::-1])]
    assert found[0] == found[1]


def test_dayfirst_is_anchored(spark):
    df = spark.createDataFrame([("15.03.2024",), ("15.03.20245",), ("15.03.2024garbage",), ("15.03.2024 10:30",)], "t string")
    assert [r.d for r in df.select(fn.to_date_dayfirst("t").alias("d")).collect()] == [D(2024, 3, 15), None, None, D(2024, 3, 15)]


def test_means_keep_digits_and_large_values(spark):
    df = spark.createDataFrame([(100 / 1.36,), (101 / 1.36,), (103 / 1.36,)], "x double")
    assert abs(df.agg(fn.decimal_mean("x").alias("m")).first().m - 304 / 3 / 1.36) < 1e-8
    assert spark.createDataFrame([(1e17,), (1e17,)], "x double").agg(fn.decimal_sum("x").alias("s")).first().s == 2e17


def test_strict_json_and_headers(spark, tmp_path):
    import pytest

    from lakemart.sources import bronze
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception):
        bronze.jsonl_to_variant(spark, str(tmp_path / "a.jsonl")).collect()
    lenient = bronze.jsonl_to_variant(spark, str(tmp_path / "a.jsonl"), strict=False)
    assert bronze.malformed(lenient).first().n_malformed == 1
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("x;y\n1;2\n")
    (folder / "b.csv").write_text("y;x\n2;1\n")
    with pytest.raises(Exception):
        bronze.csv_to_variant(spark, str(folder), ";").collect()


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([("\t a b \n",)], "t string")
    assert df.select(fn.strip("t").alias("s")).first().s == "a b"


def test_no_selected_rows_is_an_error(spark):
    from lakemart.operators.extract import require_rows
    some = spark.range(2)
    assert require_rows(some) is some
    with pytest.raises(ValueError, match="no catch lines"):
        require_rows(some.filter("id > 5"))


def test_schema_is_created_and_table_replaced(spark, tmp_path):
    from lakemart.sources import sinks
    sinks.ensure_schema(spark, "spark_catalog.lakemart_gold", str(tmp_path / "gold"))
    for df in (spark.range(3), spark.range(2).withColumn("kg", F.lit(1.5))):
        sinks.write_table(df, "spark_catalog.lakemart_gold.weekly", path=str(tmp_path / "weekly"))
    back = sinks.read_table(spark, "spark_catalog.lakemart_gold.weekly")
    assert back.columns == ["id", "kg"] and back.count() == 2
    spark.sql("DROP TABLE spark_catalog.lakemart_gold.weekly")
    spark.sql("DROP SCHEMA spark_catalog.lakemart_gold")


def test_scratch_goes_with_the_application(spark):
    from lakemart.session import scratch_path
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    assert spark.sparkContext.applicationId in first


def test_kept_models_follow_the_data(spark, tmp_path):
    from lakemart.plans.layers import version as _version
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    before = _version(spark, str(tmp_path))
    assert before == _version(spark, str(tmp_path))
    spark.range(4).write.parquet(str(tmp_path / "b.parquet"))
    assert before != _version(spark, str(tmp_path))
