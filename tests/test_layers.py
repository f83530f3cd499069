"""Silver, Gold, star-schema and view semantics on small literal fixtures."""

import pytest
from pyspark.sql import functions as F

from econ_lake.operators import gold, hierarchy, serving, silver, warehouse
from econ_lake.sources.catalog import catalog_frame

RAW = "source string, dataset_id string, vintage_tag string, run_id string, load_seq int, row map<string,string>"


def _bea(spark, rows, dataset="pce_state_sapce4", freq="A", table="SAPCE4", vintage="2026-03-04", seq=1):
    cat = catalog_frame(spark, [{"dataset_id": dataset, "source": "bea", "bea_table_name": table,
                                 "bea_frequency": freq}])
    raw = spark.createDataFrame([("bea", dataset, vintage, f"run-{seq}", seq, r) for r in rows], RAW)
    return silver.bea_silver(raw, cat)


def _row(fips="01000", tp="2024", code="SAPCE4-1", value="123.4", label="[SAPCE4] PCE: Life insurance", **kw):
    r = {"GeoFips": fips, "GeoName": "Alabama", "TimePeriod": tp, "Code": code, "FunctionName": label,
         "DataValue": value, "CL_UNIT": "Millions of current dollars", "UNIT_MULT": "6"}
    r.update(kw)
    return r


def test_geo_filter_drops_nation_and_region(spark):
    s = _bea(spark, [_row("00000"), _row("01000"), _row("91000")]).collect()
    assert len(s) == 1 and s[0].state_abbrev == "AL" and s[0].line_code == "1"
    assert s[0].bea_table_name == "SAPCE4" and s[0].note_ref == ""


def test_monthly_and_frequency_filter(spark):
    s = _bea(spark, [_row(tp="2024"), _row(tp="2024M02")], freq="M").collect()
    assert [(r.frequency, r.period_code, r.month) for r in s] == [("M", "2024M02", 2)]


def test_gold_scaling_and_conformed_order(spark):
    g = gold.bea_conformed(gold.bea_gold(_bea(spark, [_row(value="100.0")])))
    r = g.first()
    assert r.pce_value == 100.0 and r.pce_value_scaled == 1.0e8 and r.source_name == "BEA"
    assert g.columns[:23] == gold.CONFORMED_COLUMNS


def test_census_finance_conformed(spark):
    cat = catalog_frame(spark, [{"dataset_id": "fin", "source": "census", "census_dataset_path": "timeseries/govs",
                                 "census_variable": "AMOUNT", "census_series_kind": "state_gov_finance",
                                 "census_measure_label": "Federal intergovernmental revenue",
                                 "census_predicates": {"AGG_DESC": "SF0004"}}])
    raw = spark.createDataFrame([("census", "fin", "2026-03-04", "r", 1,
                                  {"NAME": "Alabama", "AMOUNT": "17107053", "state": "1", "YEAR": "2023"})], RAW)
    r = gold.census_conformed(silver.census_silver(raw, cat)).first()
    assert r.series_code == "TIMESERIES_GOVS-AMOUNT-SF0004" and r.unit_mult == 3
    assert r.pce_value_scaled == 17107053000.0 and r.state_fips == "01"


def _conf(spark, rows):
    cols = gold.CONFORMED_COLUMNS + ["run_id", "load_seq"]
    base = dict(source_name="BEA", dataset_id="d", bea_table_name="T", frequency="A", month=None, quarter=None,
                state_fips="06", state_abbrev="CA", geo_name="California", line_code="1", series_code="T-1",
                series_name="", function_name="F", raw_description="F", hierarchy_path_json='["F"]', unit="u",
                unit_mult=0, note_ref="", run_id="r")
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        d["period_code"] = str(d["year"])
        d.setdefault("pce_value_scaled", d["pce_value"])
        data.append(tuple(d[c] for c in cols))
    schema = ("source_name string, dataset_id string, bea_table_name string, frequency string, period_code string, "
              "year int, month int, quarter int, state_fips string, state_abbrev string, geo_name string, "
              "line_code string, series_code string, series_name string, function_name string, "
              "raw_description string, hierarchy_path_json string, unit string, unit_mult int, vintage_tag string, "
              "pce_value double, pce_value_scaled double, note_ref string, run_id string, load_seq int")
    return spark.createDataFrame(data, schema)


def test_yoy_gap_gives_null(spark):
    c = _conf(spark, [dict(year=y, pce_value=v, vintage_tag="v1", load_seq=1)
                      for y, v in [(2000, 10.0), (2001, 11.0), (2003, 12.0), (2004, 0.0), (2005, 5.0)]])
    obt = serving.obt_annual_latest(warehouse.build_star(c))
    for fn in (serving.yoy_view, serving.yoy_view_window):
        got = {r.year: r.yoy_pct for r in fn(obt).collect()}
        assert got[2000] is None and abs(got[2001] - 10.0) < 1e-12 and got[2003] is None and got[2005] is None


def test_latest_vintage_is_last_loaded(spark):
    c = _conf(spark, [dict(year=2000, pce_value=1.0, vintage_tag="2026-03-04", load_seq=1),
                      dict(year=2000, pce_value=2.0, vintage_tag="2026-03-03", load_seq=2)])
    rows = serving.obt_annual_latest(warehouse.build_star(c)).collect()
    assert [(r.vintage_tag, r.pce_value) for r in rows] == [("2026-03-03", 2.0)]


def test_geo_last_distinct_name_wins(spark):
    c = _conf(spark, [dict(year=2000, pce_value=1.0, vintage_tag="v", load_seq=1, geo_name="Old"),
                      dict(year=2001, pce_value=1.0, vintage_tag="v", load_seq=1, geo_name="New"),
                      dict(year=2002, pce_value=1.0, vintage_tag="v", load_seq=1, geo_name="Old")])
    assert warehouse.build_star(c).dim_geo.first().geo_name == "New"


def test_hierarchy_nodes_and_bridge(spark):
    ser = spark.createDataFrame(
        [(1, 7, "T", '["A", "B", "C"]', "", "", "1"), (2, 7, "T", '["A", "B"]', "", "", "2"),
         (3, 7, "T", '["A"]', "", "", "3"), (4, 7, "T", "not json", "Fn", "", "4"), (5, 7, "T", "{}", "", "", "L5")],
        "series_id long, source_id long, bea_table_name string, hierarchy_path_json string, function_name string, "
        "series_name string, line_code string")
    nodes, bridge = hierarchy.series_nodes(ser)
    assert sorted(r.node_key for r in nodes.collect()) == ["A", "A||B", "A||B||C", "Fn", "L5"]
    b = bridge.collect()
    assert len(b) == 3 + 2 + 1 + 1 + 1
    leaves = {}
    for r in b:
        leaves[r.series_id] = leaves.get(r.series_id, 0) + int(r.is_leaf)
    assert set(leaves.values()) == {1}


def _merge(spark, root, rows, schema="k long, v string, x double", **options):
    from econ_lake.operators.tables import Tables

    tables = Tables(spark, root)
    tables.merge("t", spark.createDataFrame(rows, schema), ["k"], **options)
    return tables


def test_merge_keeps_vanished_rows_and_comes_to_the_same_again(spark, tmpdir_path):
    _merge(spark, tmpdir_path, [(1, "a", 1.0), (2, "a", 2.0)])
    for _ in range(2):
        tables = _merge(spark, tmpdir_path, [(1, "a", 5.0)])
        assert sorted((r.k, r.x) for r in tables.read("t").collect()) == [(1, 5.0), (2, 2.0)]
    with pytest.raises(ValueError, match="several rows"):
        _merge(spark, tmpdir_path, [(1, "a", 5.0), (1, "b", 6.0)])


def test_merge_new_and_lost_columns(spark, tmpdir_path):
    _merge(spark, tmpdir_path, [(1, "a", 1.0), (2, "b", 2.0)])
    tables = _merge(spark, tmpdir_path, [(2, 9)], "k long, y int", defaults={"y": 7})
    assert sorted(tuple(r) for r in tables.read("t").select("k", "v", "x", "y").collect()) == [
        (1, "a", 1.0, 7), (2, None, None, 9)]
    with pytest.raises(ValueError, match="is int"):
        _merge(spark, tmpdir_path, [(1, "x")], "k long, y string")
    tables.drop("t")
    assert tables.read("t") is None


def test_old_files_have_the_default_and_another_session_finds_the_table(spark, tmpdir_path):
    from econ_lake.operators.tables import Tables

    tables = Tables(spark, tmpdir_path)
    tables.merge("t", spark.createDataFrame([(1, 10)], "k long, p long"), ["k", "p"], part="p")
    tables.merge("t", spark.createDataFrame([(2, 20, "new")], "k long, p long, v string"), ["k", "p"], part="p",
                 defaults={"v": "old"})
    assert sorted((r.k, r.v) for r in tables.read("t").collect()) == [(1, "old"), (2, "new")]
    spark.sql(f"DROP TABLE {tables.name('t')}")  # the catalog entry is gone, the files stay
    assert sorted((r.k, r.p) for r in tables.read("t").collect()) == [(1, 10), (2, 20)]
    tables.merge("t", spark.createDataFrame([(1, 10, "x")], "k long, p long, v string"), ["k", "p"], part="p")
    assert sorted((r.k, r.v) for r in tables.read("t").collect()) == [(1, "x"), (2, "new")]


def test_merge_rewrites_touched_partitions_only_and_leaves_the_stored_side_in_place(spark, tmpdir_path):
    import glob
    import os

    from econ_lake.operators import tables as TB

    tables = TB.Tables(spark, tmpdir_path)
    for rows in ([(1, 10, "a"), (2, 20, "b")], [(3, 20, "c")]):
        before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmpdir_path}/t/p=10/*.parquet")}
        tables.merge("t", spark.createDataFrame(rows, "k long, p long, v string"), ["k", "p"], part="p")
    assert before and before == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmpdir_path}/t/p=10/*.parquet")}
    assert sorted(r.k for r in tables.read("t").collect()) == [1, 2, 3]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with TB._settings(spark):
            new = spark.createDataFrame([(2, 20, "x")], "k long, p long, v string")
            plan = tables.merged("t", new, ["k", "p"], "p")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    stored = plan[:plan.index("FileScan")].rsplit("SortMergeJoin", 1)[1]
    assert "LeftAnti" in plan and "Bucketed: true" in plan and "Exchange" not in stored
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_an_unfinished_load_is_not_seen_and_is_run_again(spark, tmpdir_path, monkeypatch):
    from econ_lake.operators import serving
    from econ_lake.operators.tables import Tables

    tables = Tables(spark, tmpdir_path)
    first = _conf(spark, [dict(year=2020, pce_value=1.0, vintage_tag="2026-01-01", load_seq=1)])
    second = _conf(spark, [dict(year=2020, pce_value=2.0, vintage_tag="2026-02-01", load_seq=2)])

    def wide():
        return [(r.vintage_tag, r.pce_value) for r in serving.obt_annual_latest(warehouse.read_star(tables)).collect()]

    warehouse.load(tables, first, "2026-01-01")
    assert wide() == [("2026-01-01", 1.0)]
    merge = Tables.merge

    def fails(self, table, *args, **kwargs):
        if table == "dim_vintage":
            raise RuntimeError("lost the connection")
        return merge(self, table, *args, **kwargs)

    monkeypatch.setattr(Tables, "merge", fails)
    with pytest.raises(RuntimeError):
        warehouse.load(tables, second, "2026-02-01")
    assert wide() == [("2026-01-01", 1.0)]
    monkeypatch.setattr(Tables, "merge", merge)
    warehouse.load(tables, second, "2026-02-01")
    assert wide() == [("2026-02-01", 2.0)] and tables.read("fact").count() == 2


def test_star_load_refuses_nothing(spark, tmpdir_path):
    from econ_lake.operators.tables import Tables

    with pytest.raises(ValueError, match="empty"):
        warehouse.load(Tables(spark, tmpdir_path), _conf(spark, []), "2026-01-01")


def test_incomplete_trend_is_reported_and_refused(spark):
    from econ_lake.operators import analysis

    trend = spark.createDataFrame([("CA", "Goods", y, 1.0) for y in range(2020, 2024)],
                                  "state_abbrev string, category string, year int, rpp double")
    row = analysis.state_change_summary(trend).first()
    assert (row.start_year, row.end_year, row.complete) == (2020, 2023, False)
    with pytest.raises(ValueError, match="exactly 5"):
        analysis.assert_complete(trend)


def test_share_gate_sees_full_precision(spark):
    from econ_lake.operators import analysis

    w = spark.createDataFrame([(2020, "Goods", 0.5), (2020, "Goods", 0.5000000149)],
                              "year int, category string, pce_share double")
    assert analysis.share_sum_report(w).first().ok is False


def test_per_capita_population_only(spark):
    c = _conf(spark, [
        dict(year=2012, pce_value=100.0, vintage_tag="v", load_seq=1),
        dict(source_name="CENSUS", dataset_id="census_state_population", bea_table_name="ACS_ACS1", line_code="P",
             series_code="P", year=2012, pce_value=10.0, vintage_tag="v", load_seq=2),
        dict(source_name="CENSUS", dataset_id="fin", bea_table_name="GOVS", line_code="A", series_code="A",
             year=2012, pce_value=1.0, vintage_tag="v", load_seq=3),
    ])
    obt = serving.obt_annual_latest(warehouse.build_star(c))
    assert serving.per_capita_view(obt).count() == 1
    assert serving.per_capita_view(obt, population_dataset_id=None).count() == 2


def test_no_rows_give_typed_empty_frames(spark):
    cat = catalog_frame(spark, [{"dataset_id": "d", "bea_table_name": "T"}, {"dataset_id": "c", "source": "census"}])
    raw = spark.createDataFrame([], RAW)
    conf = gold.conformed_observations(silver.bea_silver(raw, cat), silver.census_silver(raw, cat))
    assert conf.count() == 0
    types = dict(conf.dtypes)
    assert (types["year"], types["pce_value"], types["state_fips"]) == ("int", "double", "string")


def test_layer_is_sorted_and_replaces_its_partitions_only(spark, tmpdir_path):
    from econ_lake.sources import layers

    rows = _bea(spark, [_row(code=c, tp=t) for t in ("2024", "2023") for c in ("SAPCE4-2", "SAPCE4-1")])
    other = _bea(spark, [_row()], dataset="other")
    layers.write_layer(other, tmpdir_path + "/s")
    for _ in range(2):
        layers.write_layer(rows, tmpdir_path + "/s")
    got = layers.read_layer(spark, tmpdir_path + "/s", rows.schema)
    assert got.dtypes == rows.dtypes and got.count() == 5
    kept = [(r.period_code, r.line_code) for r in got.filter("dataset_id <> 'other'").collect()]
    assert kept == sorted(kept)


def test_combined_csv(spark, tmpdir_path):
    from econ_lake.operators import analysis

    w = spark.createDataFrame([(y, s, c, 1.0, 0.5, 0.5) for y in range(2019, 2024) for s in ("CA", "TX")
                               for c in ("Goods",)],
                              "year int, state_abbrev string, category string, rpp double, pce_share double, "
                              "weighted_rpp double")
    combined = analysis.combined_output(w)
    combined = combined.withColumn("state_abbrev", F.coalesce("state_abbrev", F.when(F.col("category") == "Other", "")))
    analysis.write_combined_csv(combined, tmpdir_path + "/csv")
    back = analysis.read_combined_csv(spark, tmpdir_path + "/csv", combined.schema)
    assert back.columns == analysis.COMBINED_COLUMNS
    assert sorted(map(str, back.collect())) == sorted(map(str, combined.collect()))
    other = combined.withColumnRenamed("rpp", "level").schema
    with pytest.raises(Exception, match="(?i)header"):
        analysis.read_combined_csv(spark, tmpdir_path + "/csv", other).collect()
    analysis.assert_study(w)
