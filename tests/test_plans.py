"""Physical-plan checks: pushdown, partial limits, broadcasts, exchange counts."""

from __future__ import annotations

from lakemart.plans import layers
from lakemart.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_cuts_groups_before_the_shuffle(spark):
    for df, key in ((layers.silver_landings(spark, SF_SMALL), "note_id"), (layers.silver_sea(spark, SF_SMALL), "date")):
        lines = plan(df).splitlines()
        shuffle = next(i for i, ln in enumerate(lines) if f"Exchange hashpartitioning({key}" in ln)
        assert "WindowGroupLimit" in lines[shuffle + 1] and lines[shuffle + 1].rstrip().endswith("Partial")
        assert sum("REPARTITION" in ln for ln in lines) == 0


def test_map_only_queries_do_not_shuffle(spark):
    for qid in ("filt_positive", "filt_dropna", "filt_valid_split", "fn_lpad"):
        text = plan(QUERIES[qid](spark, SF_SMALL))
        assert "Exchange" not in text.replace("BroadcastExchange", ""), qid


def test_scan_prunes_columns_and_filters_in_it(spark):
    text = plan(QUERIES["filt_positive"](spark, SF_SMALL))
    scan = next(ln for ln in text.splitlines() if "lineitem.parquet" in ln)
    assert "l_extendedprice" in spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").columns
    assert "l_extendedprice" not in scan and "l_quantity" in scan
    assert "(l_quantity" in scan.split("DataFilters: ")[1].split("Format:")[0]


def test_small_dimensions_do_not_shuffle_the_fact(spark):
    for qid in ("join_dim_species", "join_dim_area", "join_vessel_attrs", "join_dim_vessel"):
        text = plan(QUERIES[qid](spark, SF_SMALL))
        assert "SortMergeJoin" not in text, qid
        assert text.count("Exchange hashpartitioning(species_code") + text.count("Exchange hashpartitioning(area_code") == 0, qid


def scans(df) -> list[str]:
    return [ln for ln in plan(df).splitlines() if "FileScan" in ln]


def test_layers_are_written_once(spark):
    tables = layers.Layers(spark, SF_SMALL)
    built = tables.build()
    assert list(built) == list(layers.Layers.NAMES)
    for name, df in built.items():
        assert len(scans(df)) == 1 and "lakemart-scratch" in scans(df)[0], name
        assert getattr(tables, name) is df
    files = [f for df in built.values() for f in df.inputFiles()]
    tables.drop()
    where = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    assert files and not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
    assert layers.shared(spark, SF_SMALL) is layers.shared(spark, SF_SMALL)


def test_marts_read_written_layers(spark):
    """No query behind Silver scans a raw table; the written fact is scanned once."""
    for qid in ("mart_week", "mart_features", "mart_features_dense", "pred_baseline", "fact_landings", "join_dim_vessel", "join_dim_date", "dash_week_species",
                "agg_metrics_by_species", "sink_overwrite_schema"):
        found = scans(QUERIES[qid](spark, SF_SMALL))
        assert not [s for s in found if "lineitem.parquet" in s or "orders.parquet" in s], qid
        assert sum("silver-landings" in s or "silver_landings" in s for s in found) <= 1, qid


def test_bucketed_layers_join_without_a_shuffle(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = layers.shared(spark, SF_SMALL)
        assert tables.bucketed
        for df in (tables.fact_plan(), QUERIES["join_dim_vessel"](spark, SF_SMALL), QUERIES["join_vessel_attrs"](spark, SF_SMALL)):
            text = plan(df)
            assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
        mart = plan(tables.mart_plan())
        below = mart[mart.index("SortMergeJoin [vessel_id"):]  # the vessel join and all under it
        assert "Exchange" not in below.split("silver-sea")[0].split("ReusedExchange")[0].split("week_start")[0]
        assert "hashpartitioning(vessel_id" not in mart
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_vessel_leaves_the_tables_plain(spark, monkeypatch):
    monkeypatch.setattr(layers, "hottest_share", lambda df, column: 1 / 3)
    tables = layers.Layers(spark, SF_SMALL, buckets=64)
    assert not tables.bucketed and "Bucketed: true" not in plan(tables.silver_vessels)
    tables.drop()


def test_partitioned_tables_prune(spark):
    found = scans(QUERIES["src_table_year"](spark, SF_SMALL))
    assert len(found) == 1 and "year" in found[0].split("PartitionFilters: [")[1].split("]")[0]


def test_facets_scan_a_dataset_once(spark):
    found = scans(QUERIES["dash_facets"](spark, SF_SMALL))
    assert len(found) == 2
    # joined to written dimensions, the written Silver is scanned and nothing is deduplicated again
    assert "Window" not in plan(QUERIES["join_dim_species"](spark, SF_SMALL))


def test_feature_windows_share_one_exchange(spark):
    text = plan(QUERIES["mart_features"](spark, SF_SMALL))
    series_windows = [ln for ln in text.splitlines()
                      if "Window [" in ln and "windowspecdefinition(species_code" in ln]
    assert len(series_windows) == 1
    assert text.count("Exchange hashpartitioning(species_code") == 1


def test_fact_table_not_shuffled_for_small_dimensions(spark):
    text = plan(QUERIES["silver_landings"](spark, SF_SMALL))
    assert "hashpartitioning(l_suppkey" not in text and "hashpartitioning(l_partkey" not in text


def test_size_check_refuses_large_sides(spark):
    from lakemart.operators.joins import broadcast_if_fits, fits_broadcast
    from lakemart.plans.bindings import Tables
    li = Tables(spark, SF_SMALL).lineitem
    assert fits_broadcast(li, threshold=10)  is False
    assert broadcast_if_fits(li, threshold=10) is li


def test_vessel_and_forecast_queries_shuffle_the_lines_three_times(spark, monkeypatch):
    """ml_fit, fact_landings_joined, filt_train and join_dim_vessel beyond the broadcast limit: all work on the
    lines is in the written Silver (by part, note and bucket); what follows moves no landing before it is aggregated."""
    from lakemart.operators import forecast as fc
    from lakemart.plans.queries import q_forecast
    laid, written, shared, fit = [], [], {}, fc.fit
    share, write = layers.hottest_share, layers.write_bucketed
    monkeypatch.setattr(layers, "hottest_share", lambda df, column: laid.append(plan(df)) or share(df, column))
    monkeypatch.setattr(layers, "write_bucketed", lambda df, *args: written.append(plan(df)) or write(df, *args))
    monkeypatch.setattr(layers, "shared", lambda session, sf: shared.setdefault(sf, layers.Layers(session, sf)))
    monkeypatch.setattr(fc, "fit", lambda train, names, params, encode: fit(train, names, fc.ForestParams(num_trees=2, max_depth=2), encode))
    monkeypatch.setattr(q_forecast, "_ROWS", {})
    monkeypatch.setattr(q_forecast, "_MODELS", {})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tables = layers.shared(spark, SF_SMALL)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
        tables.silver_landings
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
        ends = {qid: plan(QUERIES[qid](spark, SF_SMALL)) for qid in ("fact_landings_joined", "join_dim_vessel", "filt_train", "ml_fit")}
        lines = [p for p in written if "lineitem.parquet" in p]
        assert len(laid) == len(lines) == 1 and "Join" not in laid[0] and "Exchange" not in laid[0]
        assert lines[0].count("Exchange hashpartitioning") == 3 and "SortMergeJoin" not in lines[0]  # lines by part and note, and the parts
        assert all("Exchange hashpartitioning" not in p and "lineitem.parquet" not in p for p in ends.values())
        mart = plan(tables.mart_plan())
        assert "hashpartitioning(note_id" not in mart and "hashpartitioning(vessel_id" not in mart
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        tables.drop()
