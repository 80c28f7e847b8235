"""Sources: payload flattening, station discovery, drift-tolerant scan, CSV seed, optional documents."""

import json
import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gaugeflow.sources import bronze as bronze_src
from gaugeflow.sources import dims, meta, payloads


def _write_lines(spark, docs):
    d = tempfile.mkdtemp(prefix="gf-payload-")
    with open(os.path.join(d, "p.json"), "w") as f:
        for doc in docs:
            f.write(json.dumps(doc) + "\n")
    return d


def test_flatten_object_and_bare_measure(spark):
    docs = [
        {"requested_station": "4009", "items": [
            {"measure": {"@id": "m1", "parameter": "level", "qualifier": "Stage", "unitName": "mASD",
                         "stationReference": "", "station": {"label": "Colwick"}},
             "dateTime": "2026-06-14T16:15:00Z", "value": 1.25},
            {"measure": "m2", "dateTime": "2026-06-14T16:30:00Z"},
        ]},
        {"requested_station": "4126", "items": [
            {"measure": {"@id": "m3", "stationReference": "X1", "station": "uri-only"}, "dateTime": "2026-06-14T16:45:00Z", "value": 2}
        ]},
    ]
    d = _write_lines(spark, docs)
    rows = {r.measure: r for r in payloads.flatten_readings(payloads.read_reading_payloads(spark, d)).collect()}
    assert rows["m1"].station_reference == "4009"  # empty falls through to the request
    assert rows["m1"].station_label == "Colwick" and rows["m1"].unit_name == "mASD" and rows["m1"].value == 1.25
    assert rows["m2"].parameter is None and rows["m2"].station_label is None and rows["m2"].value is None
    assert rows["m2"].station_reference == "4009"
    assert rows["m3"].station_reference == "X1" and rows["m3"].station_label is None
    import hashlib

    assert rows["m1"].reading_id == hashlib.md5(b"m1|2026-06-14T16:15:00Z").hexdigest()


def test_only_whole_payload_files_are_read(spark):
    """Every document of a file is read, however it is laid out; other text raises an error, in batch and stream."""
    from gaugeflow.streaming.bronze_stream import start_ingest

    doc = lambda k: {"requested_station": k, "items": [{"measure": f"m{k}", "dateTime": "2026-06-14T16:15:00Z", "value": 1}]}
    a, b = json.dumps(doc("1")), json.dumps(doc("2"))
    indented = json.dumps(doc("1"), indent=1)
    sound = {"lines": (f"{a}\n{b}\n", 2), "crlf": (f"{a}\r\n\r\n \t\r\n{b}", 2), "whole": (f"{indented}\n\n", 1),
             "several": (f"{indented}\n{json.dumps(doc('2'), indent=1)}\n", 2), "one line": (f"{a}{b}\n", 2)}
    broken = {"cut": f"{a}\n{b}\n{a[:40]}", "cut string": f"{a[:30]}\n{b}\n", "bracket": f"{a}]\n", "rest": f'{a},"x":{b}\n', "brace": f"{a}}}\n", "behind": f"{a}\n7\n"}
    for name, text in [*((k, v[0]) for k, v in sound.items()), *broken.items()]:
        base = tempfile.mkdtemp(prefix="gf-payload-")
        os.makedirs(f"{base}/in")
        with open(f"{base}/in/p.json", "w", newline="") as f:
            f.write(text)
        read = lambda: payloads.flatten_readings(payloads.read_reading_payloads(spark, f"{base}/in")).collect()  # noqa: B023, E731

        def stream():
            start_ingest(spark, f"{base}/in", f"{base}/bronze", f"{base}/cp").awaitTermination()  # noqa: B023
            return spark.read.parquet(f"{base}/bronze").collect()  # noqa: B023

        for run in (read, stream):
            if name in sound:
                assert len(run()) == sound[name][1], name
            else:
                with pytest.raises(Exception, match="not a JSON document"):
                    run()


def test_discover_stations_scale_shapes(spark):
    docs = [{"items": [
        {"stationReference": "1", "label": "Trent at A", "town": "Nottingham", "stageScale": {"typicalRangeHigh": 3.6}},
        {"stationReference": "2", "label": "Trent at B", "town": "Newark", "stageScale": "scale-uri"},
        {"stationReference": "3", "label": "Soar at C", "town": "Nottingham"},
    ]}]
    d = _write_lines(spark, docs)
    p = payloads.read_station_payloads(spark, d)
    got = {r.station_reference: r.typical_range_high for r in payloads.discover_stations(p, search="Trent").collect()}
    assert got == {"1": 3.6, "2": None}
    assert {r.station_reference for r in payloads.discover_stations(p, search="Trent", town="Nottingham").collect()} == {"1", "3"}


def test_drifted_bronze_scan_unions_all_files(spark):
    root = tempfile.mkdtemp(prefix="gf-bronze-")
    base = {"reading_id": ["a"], "measure": ["m"], "date_time": ["2026-06-14T16:15:00Z"],
            "_ingested_at": ["2026-06-14T17:00:00Z"], "_source_batch_id": ["b"]}
    os.makedirs(f"{root}/dt=2026-06-14")
    pq.write_table(pa.table({**base, "value": pa.array([1.5], pa.float64())}), f"{root}/dt=2026-06-14/f1.parquet")
    pq.write_table(pa.table({**base, "reading_id": ["b"], "value": pa.array(["n/a"])}), f"{root}/dt=2026-06-14/f2.parquet")
    pq.write_table(pa.table({**base, "reading_id": ["c"], "value": pa.array([None], pa.null())}), f"{root}/dt=2026-06-14/f3.parquet")
    pq.write_table(pa.table({**base, "reading_id": ["d"]}), f"{root}/dt=2026-06-14/f4.parquet")
    with open(f"{root}/_latest.json", "w") as f:
        f.write("{}")
    df = bronze_src.read_bronze(spark, root)
    got = {r.reading_id: r.value for r in df.collect()}
    assert got == {"a": "1.5", "b": "n/a", "c": None, "d": None}
    # folders of one schema each are read as folders, a single schema as its root
    even = tempfile.mkdtemp(prefix="gf-bronze-")
    for day, value in (("14", pa.array([1.5], pa.float64())), ("15", pa.array(["n/a"]))):
        os.makedirs(f"{even}/dt=2026-06-{day}")
        pq.write_table(pa.table({**base, "value": value}), f"{even}/dt=2026-06-{day}/f.parquet")
    paths = bronze_src._paths_by_schema(bronze_src.file_signatures(spark, even), even)
    assert sorted(p[0].rsplit("/", 1)[1] for p in paths) == ["dt=2026-06-14", "dt=2026-06-15"]
    assert {r.value for r in bronze_src.read_bronze(spark, even).collect()} == {"1.5", "n/a"}
    one = f"{even}/dt=2026-06-15"
    assert bronze_src._paths_by_schema(bronze_src.file_signatures(spark, one), one) == [[one]]
    os.makedirs(f"{root}/empty")
    assert bronze_src.read_bronze(spark, f"{root}/empty").count() == 0
    assert "dt" in df.columns


def test_dim_csv_keeps_text_refs(spark):
    d = tempfile.mkdtemp(prefix="gf-dim-")
    with open(f"{d}/dim.csv", "w") as f:
        f.write("station_reference,station_label,river_name,threshold_m,typical_range_high\n")
        f.write("4009,Colwick,River Trent,,3.6\nE1,Other,River X,2.0,\n")
    rows = {r.station_reference: r for r in dims.read_dim_csv(spark, f"{d}/dim.csv").collect()}
    assert rows["4009"].threshold_m is None and rows["4009"].typical_range_high == 3.6
    assert rows["E1"].threshold_m == 2.0


def test_missing_document_gives_nulls(spark):
    df = meta.read_json_or_nulls(spark, "/nonexistent/ingest_meta.json", meta.INGEST_META)
    r = df.first()
    assert r.last_ingest_utc is None and r.rows_ingested is None
    assert meta.read_test_results(spark, "/nonexistent/run_results.json").where("unique_id is not null").count() == 0


def test_run_results_stats_count_only_passes(spark):
    from gaugeflow.operators.checks import test_stats

    d = tempfile.mkdtemp(prefix="gf-rr-")
    doc = {"results": [
        {"unique_id": "test.a", "status": "pass"},
        {"unique_id": "test.b", "status": "warn"},
        {"unique_id": "test.c", "status": "pass"},
        {"unique_id": "model.x", "status": "success"},
    ]}
    with open(f"{d}/run_results.json", "w") as f:
        json.dump(doc, f, indent=2)
    r = test_stats(meta.read_test_results(spark, f"{d}/run_results.json")).first()
    assert (r.tests_passed, r.tests_total) == (2, 3)


def test_recorded_kinds_are_read_without_footers(spark, tmp_path, monkeypatch):
    """Landing records the kind of ``value``: each kind is one filtered scan of the root."""
    schema = "reading_id string, measure string, date_time string, value string, _ingested_at string, _source_batch_id string, dt date"
    rows = [(k, "m", "2026-06-14T16:15:00Z", v, "2026-06-14T17:00:00Z", "b", None) for k, v in (("a", "1.5"), ("b", "n/a"), ("c", None))]
    root = str(tmp_path)
    bronze_src.write_drifted(spark.createDataFrame(rows, schema), root)
    bronze_src.write_drifted(spark.createDataFrame([("d", *rows[0][1:])], schema), root)
    monkeypatch.setattr(bronze_src, "file_signatures", lambda *a: 1 / 0)
    df = bronze_src.read_bronze(spark, root, with_file=True)
    assert {r.reading_id: r.value for r in df.collect()} == {"a": "1.5", "b": "n/a", "c": None, "d": "1.5"}
    assert all("kind=" in r._file for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(kind") == 3 and "Python" not in plan and "Arrow" not in plan


def test_key_filters_skip_row_groups(spark, tmp_path):
    """A digest that is not there lies inside every row group's range; the filter rules them all out."""
    from pyspark.sql import functions as F

    from gaugeflow.plans.publish import key_index

    rows = spark.range(4000).select(F.md5(F.col("id").cast("string")).alias("reading_id"), F.col("id").alias("v"))
    key_index(rows.write, rows).parquet(f"{tmp_path}/with")
    rows.write.parquet(f"{tmp_path}/without")
    missing = "7" + "0" * 31
    read = {}
    for name in ("with", "without"):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            found = spark.read.parquet(f"{tmp_path}/{name}").where(F.col("reading_id") == missing)
            assert found.collect() == []
            scan = found._jdf.queryExecution().executedPlan()
            while "Scan" not in scan.nodeName():
                scan = scan.children().head()
            read[name] = scan.metrics().get("numOutputRows").get().value()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["with"] == 0 < read["without"]
