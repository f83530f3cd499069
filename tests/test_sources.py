"""Bronze sources: JSON payload scan, header matrices, hashing, streaming intake."""

import json
import os

import pytest
from pyspark.sql import functions as F

from econ_lake.sources import bronze, census
from econ_lake.streaming import intake


def _land(root, dataset, date, run, rows):
    d = os.path.join(root, dataset, f"extract_date={date}", f"run_id={run}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "payload.json"), "w") as fh:
        json.dump({"BEAAPI": {"Results": {"Data": rows, "ReleaseDate": " ", "ReleaseName": "R1"}}}, fh)
    os.makedirs(os.path.join(root, dataset, "checkpoints"), exist_ok=True)


def test_payload_scan_lineage_and_rows(spark, tmpdir_path):
    _land(tmpdir_path, "ds1", "2026-03-04", "run-1", [{"GeoFips": "01000", "DataValue": 1}, {"GeoFips": "02000"}])
    docs = bronze.read_payload_documents(spark, tmpdir_path)
    rows = bronze.payload_rows(docs).collect()
    assert len(rows) == 2 and rows[0].vintage_tag == "2026-03-04" and rows[0].run_id == "run-1"
    assert rows[0].dataset_id == "ds1"
    assert bronze.release_tag(docs).first().release_tag == "R1"


def test_header_matrix(spark):
    df = spark.createDataFrame([([["NAME", "V", "time", "time"], ["Alabama", "5", "a", "b"], ["Alaska", "6"]],),
                                ([["NAME", "X", "state"]],)], "m array<array<string>>")
    recs = df.select(bronze.header_matrix_records(F.col("m"), {"NAME": "NAME", "V": "POP", "time": "t"}).alias("r"),
                     bronze.missing_headers(F.col("m"), ["NAME", "V"]).alias("miss")).collect()
    assert recs[0].r == [{"NAME": "Alabama", "POP": "5", "t": "b"}, {"NAME": "Alaska", "POP": "6", "t": None}]
    assert recs[1].r == [] and recs[1].miss == ["V"]


def test_intercensal_case_and_alias(spark):
    docs = spark.createDataFrame([(2000, [["GEONAME", "POP", "DATE_DESC", "state"],
                                          ["A", "1", "7/1/2001 POPULATION Estimate, 2001 Population", "01"],
                                          ["A", "2", "4/1/2000 Population", "01"],
                                          ["A", "3", "7/1/2003 2003 population", "01"]])],
                                 "year int, matrix array<array<string>>")
    rows = census.intercensal_rows(docs, "B01", census.requested_years(spark, 2000, 2002)).collect()
    assert [r.row for r in rows] == [{"NAME": "A", "B01": "1", "state": "01", "YEAR": "2001"}]


def test_requested_years_are_bounded(spark):
    assert census.requested_years(spark, 2019, 2021).count() == 3
    for start in (1899, 2022):
        with pytest.raises(ValueError, match="outside"):
            census.requested_years(spark, start, 2021)


def test_latest_snapshot_opens_the_newest_only(spark, tmpdir_path):
    for k, date in enumerate(("2026-03-05", "2026-03-04")):
        _land(tmpdir_path, "ds1", date, f"run-{k}", [{"GeoFips": "01000"}])
        path = os.path.join(tmpdir_path, "ds1", f"extract_date={date}", f"run_id=run-{k}", "payload.json")
        os.utime(path, (1000 + k, 1000 + k))
    assert [r.run_id for r in bronze.latest_snapshot(spark, tmpdir_path).collect()] == ["run-1"]


def test_landed_rows_reach_silver_and_failed_payloads_are_tried_again(spark, tmpdir_path):
    from econ_lake.operators.tables import Tables
    from econ_lake.plans.run import run
    from econ_lake.sources.catalog import catalog_frame

    cat = catalog_frame(spark, [{"dataset_id": "d", "bea_table_name": "SAPCE4"}])

    def raw(run_id, seq, *values):
        rows = [("bea", "d", "2026-03-04", run_id, seq,
                 {"GeoFips": "01000", "GeoName": "Alabama", "TimePeriod": str(2000 + k), "Code": "SAPCE4-1",
                  "FunctionName": "A: B", "DataValue": v, "CL_UNIT": "u", "UNIT_MULT": "0"})
                for k, v in enumerate(values)]
        return spark.createDataFrame(rows, "source string, dataset_id string, vintage_tag string, run_id string, "
                                           "load_seq int, row map<string,string>")

    def status(rows):
        return [(r.run_id, r.status) for r in rows.collect()]

    with pytest.raises(ValueError, match="required value missing"):
        run(spark, raw("r1", 1, "1", "(NA)"), cat, tmpdir_path, "2026-03-04")
    assert status(run(spark, raw("r3", 3, "1", "2"), cat, tmpdir_path, "2026-03-04")) == [("r3", "loaded")]
    assert status(run(spark, raw("r4", 4, "1", "2"), cat, tmpdir_path, "2026-03-04")) == [("r4", "unchanged")]
    fact = Tables(spark, tmpdir_path + "/lake").read("fact").collect()
    assert sorted(r.value_numeric for r in fact) == [1.0, 2.0]


def test_catalog_rules(spark, tmpdir_path):
    from econ_lake.sources.catalog import catalog_frame, load_catalog_yaml, narrow

    path = os.path.join(tmpdir_path, "datasets.yml")
    with open(path, "w") as fh:
        fh.write("datasets:\n- {dataset_id: ' a ', bea_table_name: T, line_code: all}\n"
                 "- {dataset_id: b, source: CENSUS, enabled: false}\n"
                 "- {dataset_id: c, source: census, census_variable: x, census_predicates: {AGG_DESC: SF1}}\n")
    rows = {r.dataset_id: r for r in load_catalog_yaml(spark, path).collect()}
    assert set(rows) == {"a", "c"} and rows["a"].line_code == "ALL" and rows["a"].bea_start_year == 2000
    assert (rows["c"].census_variable, rows["c"].census_agg_desc, rows["c"].catalog_rank) == ("X", "SF1", 3)
    for bad in ([{"dataset_id": "a"}], [{"bea_table_name": "T"}], [{"dataset_id": "a", "source": "x"}], [],
                [{"dataset_id": " ", "bea_table_name": "T"}]):
        with pytest.raises(ValueError):
            catalog_frame(spark, bad)
    assert narrow(load_catalog_yaml(spark, path), "c").count() == 1
    with pytest.raises(ValueError, match="zzz"):
        narrow(load_catalog_yaml(spark, path), "zzz")


def test_row_hash_order_insensitive(spark):
    schema = "dataset_id string, run_id string, row map<string,string>"
    a = spark.createDataFrame([("d", "r", {"a": "1"}), ("d", "r", {"a": "2"})], schema)
    b = spark.createDataFrame([("d", "r", {"a": "2"}), ("d", "r", {"a": "1"})], schema)
    c = spark.createDataFrame([("d", "r", {"a": "2"}), ("d", "r", {"a": "1"}), ("d", "r", {"a": "1"})], schema)
    h = [bronze.row_set_hash(x).first().payload_hash for x in (a, b, c)]
    assert h[0] == h[1] and h[0] != h[2]


def test_change_flags(spark):
    cur = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3")], "dataset_id string, payload_hash string")
    prev = spark.createDataFrame([("b", "h2"), ("c", "zz")], "dataset_id string, payload_hash string")
    got = {r.dataset_id: r.changed for r in bronze.change_flags(cur, prev).collect()}
    assert got == {"a": True, "b": False, "c": True}


def test_streaming_intake_available_now(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze")
    _land(root, "ds1", "2026-03-03", "run-1", [{"GeoFips": "01000"}])
    target, ckpt = os.path.join(tmpdir_path, "rows"), os.path.join(tmpdir_path, "ckpt")
    intake.ingest_available(spark, root, target, ckpt)
    _land(root, "ds1", "2026-03-04", "run-2", [{"GeoFips": "01000"}, {"GeoFips": "02000"}])
    intake.ingest_available(spark, root, target, ckpt)
    got = intake.read_bronze_rows(spark, target).groupBy("vintage_tag").count().orderBy("vintage_tag").collect()
    assert [(r.vintage_tag, r["count"]) for r in got] == [("2026-03-03", 1), ("2026-03-04", 2)]


def test_a_batch_run_twice_adds_no_rows(spark, tmpdir_path):
    rows = spark.createDataFrame([("bea", "r", {"a": "1"}, "d", "2026-03-04")],
                                 "source string, run_id string, row map<string,string>, dataset_id string, "
                                 "vintage_tag string")
    target = tmpdir_path + "/rows"
    for batch in (0, 0):
        intake.write_batch(rows, batch, target)
    assert [r.load_seq for r in intake.read_bronze_rows(spark, target).collect()] == [1]
    # the run was landed again with another row: its last batch counts
    again = rows.unionByName(rows.withColumn("vintage_tag", F.lit("2026-03-05")))
    intake.write_batch(again, 1, target)
    got = intake.read_bronze_rows(spark, target).collect()
    assert sorted((r.vintage_tag, r.batch, r.load_seq) for r in got) == [("2026-03-04", 1, 1), ("2026-03-05", 1, 2)]


def test_streamed_rows_feed_silver(spark, tmpdir_path):
    from econ_lake.operators import silver
    from econ_lake.sources.catalog import catalog_frame

    root, target = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "rows")
    _land(root, "d", "2026-03-04", "r", [{"GeoFips": "01000", "TimePeriod": "2020", "Code": "T-1", "DataValue": "1"}])
    intake.ingest_available(spark, root, target, os.path.join(tmpdir_path, "ck"))
    cat = catalog_frame(spark, [{"dataset_id": "d", "bea_table_name": "T"}])
    row = silver.bea_silver(intake.read_bronze_rows(spark, target), cat).first()
    assert (row.state_abbrev, row.value, row.load_seq) == ("AL", 1.0, 1)


def test_api_errors_are_refused(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "d", "extract_date=2026-03-04", "run_id=r")
    os.makedirs(folder)
    with open(os.path.join(folder, "payload.json"), "w") as fh:
        json.dump({"BEAAPI": {"Error": {"APIErrorDescription": "Bad key", "ErrorDetail": {"Description": "x"}}}}, fh)
    docs = bronze.read_payload_documents(spark, tmpdir_path)
    assert bronze.payload_rows(docs).count() == 0
    with pytest.raises(ValueError, match="Bad key x"):
        bronze.assert_no_api_error(docs)


def test_faulty_payloads_go_to_the_quarantine(spark, tmpdir_path):
    from econ_lake.plans.run import run
    from econ_lake.sources.catalog import catalog_frame

    cat = catalog_frame(spark, [{"dataset_id": d, "bea_table_name": "T"} for d in ("good", "bad")])
    rows = [("bea", d, "2026-03-04", f"r-{d}", k, {"GeoFips": "01000", "TimePeriod": "2020", "Code": "T-1",
                                                  "DataValue": v, "UNIT_MULT": "0"})
            for k, (d, v) in enumerate((("good", "1"), ("bad", "(D)")), 1)]
    raw = spark.createDataFrame(rows, "source string, dataset_id string, vintage_tag string, run_id string, "
                                      "load_seq int, row map<string,string>")
    log = run(spark, raw, cat, tmpdir_path, "2026-03-04", strict=False)
    assert {(r.dataset_id, r.status) for r in log.collect()} == {("good", "loaded"), ("bad", "quarantined")}
    held = spark.read.parquet(tmpdir_path + "/quarantine").collect()
    assert [(r.dataset_id, r.reason) for r in held] == [("bad", "required value missing")]
    assert "(D)" in held[0].body


DOCUMENT = "source string, dataset_id string, vintage_tag string, run_id string, load_seq int, body string"
ROW = {"GeoFips": "01000", "GeoName": "Alabama", "TimePeriod": "2020", "Code": "T-1", "DataValue": "1", "UNIT_MULT": "0"}


def _document(dataset, run, seq, body, source="bea"):
    return (source, dataset, "2026-03-04", run, seq, body if isinstance(body, str | None) else json.dumps(body, indent=1))


def _rows(*rows):
    return {"BEAAPI": {"Results": {"Data": list(rows)}}}


def test_envelopes_are_judged(spark, tmpdir_path):
    from econ_lake.plans.run import run
    from econ_lake.sources.catalog import catalog_frame

    names = ["good", "error", "empty", "broken", "rootless", "null"]
    cat = catalog_frame(spark, [{"dataset_id": d, "bea_table_name": "T"} for d in names])
    error = {"BEAAPI": {"Error": {"APIErrorDescription": "Bad key", "ErrorDetail": {"Description": "x"}}}}
    bodies = [_rows(ROW), error, _rows(), json.dumps(_rows(ROW))[:-9], {"Other": 1}, None]
    docs = spark.createDataFrame([_document(d, f"r-{d}", k, b) for k, (d, b) in enumerate(zip(names, bodies, strict=True))],
                                 DOCUMENT)
    told = {"good": ("loaded", ""), "error": ("quarantined", "API error: Bad key x"), "empty": ("quarantined", "no rows"),
            "broken": ("quarantined", "broken document"), "rootless": ("quarantined", "no BEAAPI object"),
            "null": ("quarantined", "broken document")}
    with pytest.raises(ValueError, match="payload gate"):
        run(spark, docs, cat, tmpdir_path, "2026-03-04")
    for status in ("loaded", "unchanged"):
        told["good"] = (status, "" if status == "loaded" else None)
        log = run(spark, docs, cat, tmpdir_path, "2026-03-04", strict=False)
        assert {r.dataset_id: (r.status, r.reason) for r in log.collect()} == told
        held = spark.read.parquet(tmpdir_path + "/quarantine").select("dataset_id", "reason").collect()
        assert sorted(map(tuple, held)) == sorted((d, r) for d, (s, r) in told.items() if s == "quarantined")


def test_a_run_of_bad_payloads_only_is_recorded(spark, tmpdir_path):
    from econ_lake.plans.run import run
    from econ_lake.sources.catalog import catalog_frame

    cat = catalog_frame(spark, [{"dataset_id": "d", "bea_table_name": "T"}])
    docs = spark.createDataFrame([_document("d", "r", 1, _rows())], DOCUMENT)
    assert [(r.status, r.reason) for r in run(spark, docs, cat, tmpdir_path, "2026-03-04", strict=False).collect()] == [
        ("quarantined", "no rows")]


def test_a_run_landed_again_replaces_its_documents_and_reads_are_pruned(spark, tmpdir_path):
    from econ_lake.sources.landing import LandingZone, documents_of

    zone = LandingZone(spark, tmpdir_path)
    raw = spark.createDataFrame(
        [("bea", d, "2026-03-04", f"r-{d}", 1, dict(ROW, DataValue=str(v))) for d in "ab" for v in (1, 2, 2)],
        "source string, dataset_id string, vintage_tag string, run_id string, load_seq int, row map<string,string>")
    for _ in range(2):  # the first load failed after landing: no checkpoint was moved
        log = zone.land(documents_of(raw), "2026-03-04")
        assert [r.changed for r in log.collect()] == [True, True]
        assert zone.rows("bea").groupBy("run_id").count().orderBy("run_id").collect() == [("r-a", 3), ("r-b", 3)]
        assert zone.log().count() == 2
    one = zone.documents("bea", log.filter("dataset_id = 'a'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "dataset_id" in filters and "r-a" in filters.split("]")[0] + filters.split("]")[1] and one.count() == 1
    zone.confirm(log)
    again = zone.land(documents_of(raw.withColumn("run_id", F.concat("run_id", F.lit("2")))), "2026-03-05")
    assert [r.changed for r in again.collect()] == [False, False]
    assert zone.rows("bea").select("run_id").distinct().count() == 2


def test_rows_are_dealt_into_documents_by_number(spark, monkeypatch):
    from econ_lake.sources import landing

    monkeypatch.setattr(landing, "ROWS_PER_DOCUMENT", 10)
    raw = spark.createDataFrame([("bea", "d", "2026-03-04", "r", 1, ROW)] * 200,
                                "source string, dataset_id string, vintage_tag string, run_id string, load_seq int, "
                                "row map<string,string>")
    sizes = [len(json.loads(r.body)["BEAAPI"]["Results"]["Data"]) for r in landing.documents_of(raw).collect()]
    assert sum(sizes) == 200 and max(sizes) < 40


def test_newest_run_by_file_metadata(spark, tmpdir_path):
    for k, (dataset, date, run, when) in enumerate([("a", "2026-03-03", "r1", 100), ("a", "2026-03-04", "r2", 200),
                                                    ("b", "2026-03-03", "r3", 100), ("b", "2026-03-04", "r4", 100)]):
        folder = os.path.join(tmpdir_path, f"dataset_id={dataset}", f"extract_date={date}", f"run_id={run}")
        os.makedirs(folder)
        path = os.path.join(folder, f"part-{k}.txt")
        with open(path, "w") as fh:
            fh.write("{}")
        os.utime(path, (when, when))
    assert sorted(map(tuple, bronze.latest_runs(spark, tmpdir_path).collect())) == [("a", "r2"), ("b", "r3")]


def test_file_stream_over_a_landing_zone(spark, tmpdir_path):
    from econ_lake.sources.landing import LandingZone

    zone = LandingZone(spark, tmpdir_path + "/zone")
    target, ckpt = tmpdir_path + "/rows", tmpdir_path + "/ck"
    for run, rows in (("r1", [ROW]), ("r1", [ROW, dict(ROW, TimePeriod="2021")]), ("r2", [dict(ROW, TimePeriod="2022")])):
        zone.land(spark.createDataFrame([_document("d", run, 1, _rows(*rows))], DOCUMENT), "2026-03-04")
        intake.ingest_available(spark, zone.root, target, ckpt, landed=True)
    got = intake.read_bronze_rows(spark, target).collect()
    assert sorted((r.run_id, r.row["TimePeriod"]) for r in got) == [("r1", "2020"), ("r1", "2021"), ("r2", "2022")]
