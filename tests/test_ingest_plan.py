"""Batch ingest run: config, lookback, station restriction, cap report, metadata."""

import json
import os
import tempfile
import pytest

from datetime import datetime

from gaugeflow.plans.ingest import ingest_run
from gaugeflow.sources import dims, meta

CONFIG = """
lookback_hours: 6
stations:
  - station_reference: "4009"
  - station_reference: "4126"
"""


def test_config_parsing():
    cfg = dims.parse_station_config(CONFIG)
    assert dims.configured_refs(cfg) == ["4009", "4126"]
    assert dims.lookback_hours(cfg) == 6 and dims.lookback_hours(cfg, 0) == 6 and dims.lookback_hours(cfg, 48) == 48


def test_ingest_run(spark):
    base = tempfile.mkdtemp(prefix="gf-ingest-")
    os.makedirs(f"{base}/in")
    items = [{"measure": "m1", "dateTime": f"2026-06-14T{h:02d}:00:00Z", "value": float(h)} for h in range(0, 12)]
    other = [{"measure": "m9", "dateTime": "2026-06-14T11:00:00Z", "value": 1.0}]
    with open(f"{base}/in/p.json", "w") as f:
        f.write(json.dumps({"requested_station": "4009", "items": items}) + "\n")
        f.write(json.dumps({"requested_station": "9999", "items": other}) + "\n")
    cfg = dims.parse_station_config(CONFIG)
    run = datetime(2026, 6, 14, 12, 0, 0)
    r = ingest_run(spark, f"{base}/in", f"{base}/bronze", cfg, run, meta_path=f"{base}/ingest_meta.json")
    assert r.since == "2026-06-14T06:00:00Z"
    # 07:00..11:00 are after the exclusive 06:00 bound: all 5 rows land
    assert r.rows == 5
    m = meta.read_json_or_nulls(spark, f"{base}/ingest_meta.json", meta.INGEST_META).first()
    assert m.rows_ingested == 5 and m.stations == 2 and m.last_ingest_utc == "2026-06-14T12:00:00Z"
    hb = meta.read_json_or_nulls(spark, f"{base}/bronze/_latest.json", meta.INGEST_META).first()
    assert hb.last_ingest_utc == "2026-06-14T12:00:00Z"


def test_empty_ingest_writes_its_documents(spark):
    base = tempfile.mkdtemp(prefix="gf-ingest-empty-")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/p.json", "w") as f:
        f.write(json.dumps({"requested_station": "4009", "items": []}, indent=2))
    r = ingest_run(spark, f"{base}/in", f"{base}/bronze", {}, datetime(2026, 6, 14, 12), meta_path=f"{base}/meta.json")
    assert r.rows == 0
    m = meta.read_json_or_nulls(spark, f"{base}/meta.json", meta.INGEST_META).first()
    assert m.rows_ingested == 0 and m.last_ingest_utc == "2026-06-14T12:00:00Z"


def test_rows_are_counted_by_the_write(spark):
    from gaugeflow.sinks import landing

    root = f"{tempfile.mkdtemp(prefix='gf-count-')}/bronze"
    times = [f"2026-06-{d:02d}T00:00:00Z" for d in (1, 1, 2, 3)] + [None]
    rows = spark.createDataFrame([(f"r{i}", "4009", t, float(i)) for i, t in enumerate(times)], "reading_id string, station_reference string, date_time string, value double")
    assert landing.land_bronze(rows, root, "2026-06-14T18:00:00Z") == 5
    assert landing.land_bronze(rows.filter("value < 2"), root, "2026-06-14T21:00:00Z", by="run") == 2
    assert landing.land_bronze(rows.limit(0), root, "2026-06-15T00:00:00Z") == 0
    assert landing.land_bronze(rows, root, "2026-06-14T18:00:00Z") == 5  # a retry counts its own rows
    assert spark.read.parquet(root).count() == 7


def test_documents_over_lines_and_per_line(spark):
    from gaugeflow.sources import payloads

    base = tempfile.mkdtemp(prefix="gf-docs-")
    doc = lambda n: {"requested_station": "1", "items": [{"measure": "m", "dateTime": f"2026-06-14T{n:02d}:00:00Z", "value": n}]}
    with open(f"{base}/indented.json", "w") as f:
        f.write(json.dumps(doc(1), indent=4))
    with open(f"{base}/lines.json", "w") as f:
        f.write(json.dumps(doc(2)) + "\n\n" + json.dumps(doc(3)) + "\n")
    flat = payloads.flatten_readings(payloads.read_reading_payloads(spark, base))
    assert sorted(r["date_time"] for r in flat.collect()) == [f"2026-06-14T0{n}:00:00Z" for n in (1, 2, 3)]
    with open(f"{base}/broken.json", "w") as f:
        f.write('{"items": [')
    with pytest.raises(Exception, match="not a JSON document"):
        payloads.read_reading_payloads(spark, base).collect()
