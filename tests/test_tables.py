"""Tables, files and streams: replacement, headers, replies, holidays, incremental ingest."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.operators import extract as ex
from lakemart.operators import features as feat
from lakemart.operators import gold, silver
from lakemart.plans import layers
from lakemart.sources import bronze, calendar, files, sinks
from tests.conftest import SF_SMALL


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{tmp_path.name.replace('-', '_')}"
    yield name, str(tmp_path / "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def failing(df):
    return df.withColumn("kg", F.when(F.col("id") == 5, F.raise_error(F.lit("no")).cast("double")).otherwise(F.lit(2.0)))


def test_a_failed_replacement_leaves_the_table(spark, table):
    name, path = table
    sinks.publish_table(spark.range(10).withColumn("kg", F.lit(1.0)), name, path)
    before = sinks.table_location(spark, name)
    with pytest.raises(Exception):
        sinks.publish_table(failing(spark.range(10)), name, path)
    assert sinks.table_location(spark, name) == before
    assert [tuple(r) for r in sinks.read_table(spark, name).agg(F.count("id"), F.sum("kg")).collect()] == [(10, 10.0)]


def test_a_table_is_replaced_with_its_schema_and_from_itself(spark, table):
    name, path = table
    sinks.publish_table(spark.range(3), name, path)
    first = sinks.read_table(spark, name)
    sinks.publish_table(sinks.read_table(spark, name).unionByName(spark.range(10, 12)), name, path)  # same schema, reads itself
    assert sinks.read_table(spark, name).count() == 5
    assert first.count() == 3  # a reader of the version before is not disturbed
    sinks.publish_table(sinks.read_table(spark, name).withColumn("odd `name`", F.lit("x")), name, path)
    back = sinks.read_table(spark, name)
    assert back.columns == ["id", "odd `name`"] and back.count() == 5
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    kept = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    assert len(kept) == sinks.KEPT_VERSIONS


def test_only_given_partitions_are_replaced(spark, table):
    name, path = table
    rows = spark.range(12).select("id", (F.col("id") % 3).cast("int").alias("year"), F.lit(1.0).alias("kg"))
    sinks.publish_table(rows, name, path, partition_by=["year"])
    sinks.replace_partitions(rows.filter("year = 1").withColumn("kg", F.lit(7.0)), name, ["year"])
    sinks.replace_partitions(spark.range(2).select("id", F.lit(9).alias("year"), F.lit(3.0).alias("kg")), name, ["year"])
    expected = {0: (4, 4.0), 1: (4, 28.0), 2: (4, 4.0), 9: (2, 6.0)}
    totals = lambda: {r.year: (r.n, r.kg) for r in sinks.read_table(spark, name).groupBy("year").agg(F.count("id").alias("n"), F.sum("kg").alias("kg")).collect()}
    assert totals() == expected
    with pytest.raises(Exception):
        sinks.replace_partitions(failing(rows.filter("year = 2")), name, ["year"])
    assert totals() == expected
    sinks.publish_table(rows, name, path, partition_by=["year"])  # the whole table again: the added year goes
    assert set(totals()) == {0, 1, 2}


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    folder = tmp_path / "2024"
    folder.mkdir()
    (folder / "a.csv").write_text("x;y\n1;2\n")
    (folder / "b.csv").write_text("\ufeffy;z;x\n\"4;4\";9;3\n", encoding="utf-8")
    (folder / "empty.csv").write_text("")
    (folder / "_hidden").write_text("q\n")
    rows = files.read_years(spark, {2024: str(folder)}, ["x", "y"]).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "2", 2024), ("3", "4;4", 2024)]
    (folder / "c.csv").write_text("x;w\n1;2\n")
    with pytest.raises(files.SchemaDriftError, match="c.csv.*'y'"):
        files.read_years(spark, {2024: str(folder)}, ["x", "y"])


def test_replies_open_and_short_arrays_fail(spark, tmp_path):
    good = '{"area": "03", "hourly": {"time": ["t0", "t1"], "sea_surface_temperature": [1.5, null], "wave_height": [2, 3.25], "ocean_current_velocity": [null, 4]}}'
    (tmp_path / "a.jsonl").write_text(good + "\n")
    rows = files.open_replies(bronze.jsonl_to_variant(spark, str(tmp_path / "a.jsonl")), keep=["area"]).collect()
    assert [tuple(r) for r in rows] == [("03", "t0", 1.5, 2.0, None), ("03", "t1", None, 3.25, 4.0)]
    for bad in (good.replace("[2, 3.25]", "[2]"), good.replace("[2, 3.25]", "[]"), good.replace('"wave_height"', '"other"')):
        (tmp_path / "b.jsonl").write_text(bad + "\n")
        with pytest.raises(Exception, match="hourly.wave_height has"):
            files.open_replies(bronze.jsonl_to_variant(spark, str(tmp_path / "b.jsonl"))).collect()


def test_holidays_come_from_a_rule(spark):
    found = [str(r.date) for r in calendar.calendar(spark).filter("is_holiday").orderBy("date").collect()]
    assert found == ["2024-01-01", "2024-03-28", "2024-03-29", "2024-04-01", "2024-05-01", "2024-05-09", "2024-05-17", "2024-05-20", "2024-12-25", "2024-12-26", "2025-01-01"]
    from lakemart.functions.dates import easter_sunday
    known = {1818: (3, 22), 1943: (4, 25), 1954: (4, 18), 1981: (4, 19), 2000: (4, 23), 2008: (3, 23), 2024: (3, 31), 2038: (4, 25), 2285: (3, 22)}
    rows = spark.createDataFrame([(y,) for y in known], "y int").select("y", easter_sunday(F.col("y")).alias("e")).collect()
    assert {r.y: (r.e.month, r.e.day) for r in rows} == known
    listed = calendar.calendar(spark, "2024-01-01", "2024-01-03", ["2024-01-02"]).filter("is_holiday").collect()
    assert [r.date for r in listed] == [dt.date(2024, 1, 2)]
    assert calendar.calendar(spark, "1600-01-01", "2399-12-31").count() == 292194


def test_round_mean_keeps_small_digits(spark):
    df = spark.createDataFrame([("a", 0.00049), ("a", 0.00049), ("b", -0.005), ("b", -0.005), ("c", None), ("d", 1e9), ("d", 1e9 + 0.01)], "k string, x double")
    got = {r.k: (r.four, r.two) for r in df.groupBy("k").agg(ex.round_mean("x", 4).alias("four"), ex.round_mean("x", 2).alias("two")).collect()}
    assert got == {"a": (0.0005, 0.0), "b": (-0.005, -0.01), "c": (None, None), "d": (1000000000.005, 1000000000.01)}


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    from lakemart.streaming import append_new_files, csv_stream_to_variant, jsonl_stream_to_variant
    landing, target = tmp_path / "in", str(tmp_path / "bronze")
    landing.mkdir()
    run = lambda: append_new_files(csv_stream_to_variant(spark, str(landing), ["x", "y"], ";"), target)
    read = lambda: sorted(r.x for r in spark.read.parquet(target).select(F.try_variant_get("payload", "$.x", "int").alias("x")).collect())
    for k in (1, 2, 3):
        (landing / f"{k}.csv").write_text(f"x;y\n{k};0\n")
        run()
        assert read() == list(range(1, k + 1))
    run()
    assert read() == [1, 2, 3]
    (landing / "4.csv").write_text("y;x\n6;5\n")
    with pytest.raises(Exception):
        run()
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.jsonl").write_text('{"x": 1}\n{"x": \n')
    with pytest.raises(Exception):
        append_new_files(jsonl_stream_to_variant(spark, str(lines)), str(tmp_path / "strict"))
    append_new_files(jsonl_stream_to_variant(spark, str(lines), strict=False), str(tmp_path / "lenient"))
    assert spark.read.parquet(str(tmp_path / "lenient")).count() == 2


def test_counts_are_taken_while_silver_is_written(spark, tmp_path):
    from lakemart.plans import bindings as b
    clean, counts = silver.clean_landings_observed(b.landings(spark, SF_SMALL))
    clean.write.parquet(str(tmp_path / "silver"))
    expected = silver.quality_counts(b.landings(spark, SF_SMALL)).first().asDict()
    assert counts() == expected | {"rows_out": spark.read.parquet(str(tmp_path / "silver")).count()}
    assert clean.drop("x").exceptAll(silver.clean_landings(b.landings(spark, SF_SMALL))).isEmpty()


def test_fact_of_own_dimensions_equals_the_joins(spark):
    rows = [("1", "2024-01-01", "v1", "COD", "cod", "03", "A", "g", 1.0), ("2", "2024-01-02", "v9", "COD", None, "03", None, "g", 2.0),
            ("3", "2024-01-02", "v1", "HAD", "had", "04", "B", "g", 3.0)]
    df = spark.createDataFrame(rows, "note_id string, landing_date string, vessel_id string, species_code string, species_name string, area_code string, area_name string, gear_code string, weight_kg double")
    df = df.withColumn("landing_date", F.col("landing_date").cast("date"))
    vessel = gold.dim_vessel(spark.createDataFrame([("v1", 5.0)], "vessel_id string, length_m double"))
    dates = gold.dim_date(calendar.calendar_of(df, "landing_date"))
    joined = gold.fact_landings(df, gold.dim_species(df), gold.dim_area(df), vessel, dates)
    own = gold.fact_of_own_dims(df, vessel)
    assert own.columns == joined.columns and sorted(map(str, own.collect())) == sorted(map(str, joined.collect()))


def test_dense_weeks_carry_ids_and_fleet(spark):
    mart = layers.mart(spark, SF_SMALL)
    dense = feat.carried_weeks(mart)
    assert dense.columns == mart.columns and mart.exceptAll(dense).isEmpty()
    added = dense.exceptAll(mart)
    assert added.count() > 0
    nulls = added.select([F.count_if(F.col(c).isNull()).alias(c) for c in ("species_id", "area_id", "species_name", "iso_week", "season", "active_vessels")]).first()
    assert set(nulls) == {0} and added.filter("landed_kg != 0 or n_notes != 0").isEmpty()
    w = feat.feature_mart(mart, dense=True)
    assert w.filter("lag_1 is not null and target_week != week_start + interval 7 days").isEmpty()


def test_a_species_that_training_lacks_is_scored(spark):
    from lakemart.operators import forecast as fc
    rows = spark.createDataFrame([(f"c{i % 3}", "n", "a", "x", dt.date(2024, 1, 1 + i), i % 3, float(i), float(i)) for i in range(24)],
                                 "species_code string, species_name string, area_code string, area_name string, week_start date, species_id int, landed_kg double, target_kg double")
    params = fc.ForestParams(num_trees=3, max_depth=3)
    model = fc.fit(rows.filter("species_id < 2"), ["landed_kg"], params, encode_species=True)
    assert fc.predict(model, rows, encode_species=True).filter("predicted_kg is not null").count() == 24


def odd_tables(spark, folder) -> str:
    """Small raw tables: repeated notes, parts and suppliers, missing ones, null keys, ties by area and vessel."""
    ts = "timestamp_ntz'2001-03-0%d 00:00:00'"
    lines = []
    for order in range(40):
        for copy in range(1 + order % 3):  # notes of up to three lines
            part = "NULL" if order == 7 else str((order * 5 + copy) % 9)  # 8: no such part
            supplier = "NULL" if order == 11 else str((order + copy * (order % 2)) % 8)  # 7: no such supplier
            lines.append((str(order) if order != 13 else "NULL", part, supplier, "1", f"double({(order + copy) % 4})", "0.0D" if order % 10 == 9 else "0.05D",
                          "0.08D" if (order + copy) % 6 == 5 else "0.02D", f"'{'ANR'[copy]}'", "NULL" if order == 17 and copy else ts % (1 + (order * copy) % 2)))
    rows = {
        "region": ("r_regionkey int, r_name string", [("0", "'NORTH'"), ("1", "'EAST'"), ("1", "'WEST'"), ("2", "NULL")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(str(n), f"'N{n}'", str(n % 4)) for n in range(4)]),  # region 3: none
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                     [(str(s), f"'S{s}'", str(s % 4), "1.5D") for s in range(7)] + [("0", "'S0'", "1", "2.5D"), ("4", "'S4'", "2", "2.5D"), ("NULL", "'S'", "1", "0.5D")]),
        "part": ("p_partkey bigint, p_type string", [(str(p), "NULL" if p == 5 else f"'{'abAB'[p % 4]}'") for p in range(8)] + [("2", "'Z'"), ("NULL", "'a'")]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, "
                     "l_shipdate timestamp_ntz", lines)}
    for name, (schema, values) in rows.items():
        types = [c.strip().split(" ") for c in schema.split(",")]
        spark.sql(" UNION ALL ".join("SELECT " + ", ".join(f"CAST({v} AS {t}) AS {c}" for v, (c, t) in zip(row, types)) for row in values)
                  ).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_written_silver_equals_silver_of_the_raw_tables(spark, tmp_path, monkeypatch, threshold, hot):
    from lakemart.plans import bindings as b
    monkeypatch.setattr(layers, "hottest_share", lambda df, column: float(hot))
    sf, before = odd_tables(spark, tmp_path), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    expected = sorted(map(str, layers.silver_landings(spark, sf).collect()))
    counts = silver.quality_counts(b.landings(spark, sf)).first().asDict()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    tables = layers.Layers(spark, sf)
    try:
        assert tables.bucketed is not hot
        assert sorted(map(str, tables.silver_landings.collect())) == expected and len(expected) > 5
        assert tables.silver_landings.columns == layers.silver_landings(spark, sf).columns
        assert tables.landing_counts() == counts | {"rows_out": len(expected)}
    finally:
        tables.drop()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_are_shuffled_three_times(spark, monkeypatch):
    """By part, note and vessel; the layout is chosen without a join of the lines."""
    from lakemart.plans import bindings as b
    seen = []
    monkeypatch.setattr(layers, "write_bucketed", lambda df, name, path, column, buckets, lookup=None, columns=None: seen.append(df) or df)
    monkeypatch.setattr(layers, "hottest_share", lambda df, column: seen.append(df) or 0.0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        layers.Layers(spark, SF_SMALL).silver_landings
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    share, lines = sorted((df._jdf.queryExecution().executedPlan().toString() for df in seen), key=len)
    assert "Join" not in share and "Exchange" not in share
    assert lines.count("Exchange hashpartitioning(l_partkey") == 1 and "hashpartitioning(l_suppkey" not in lines
    assert "SortMergeJoin" not in lines and lines.count("Exchange hashpartitioning") == 3  # the third: the parts
