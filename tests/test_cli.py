"""Command line: ingest → build → trace, and discover, on hand-made files."""

import json
import os
import tempfile

from gaugeflow import cli


def test_cli_ingest_build_trace_discover(spark, capsys):
    base = tempfile.mkdtemp(prefix="gf-cli-")
    os.makedirs(f"{base}/in")
    items = []
    for st in ("4009", "4126"):
        for h in range(0, 48, 6):
            items.append((st, {"measure": {"@id": f"m-{st}", "parameter": "level", "qualifier": "Stage", "unitName": "mASD",
                                           "stationReference": st, "station": {"label": f"S{st}"}},
                               "dateTime": f"2026-06-{12 + h // 24:02d}T{h % 24:02d}:00:00Z", "value": 1.0 + h / 100}))
    with open(f"{base}/in/p.json", "w") as f:
        for st, it in items:
            f.write(json.dumps({"requested_station": st, "items": [it]}) + "\n")
    with open(f"{base}/stations.yml", "w") as f:
        f.write('lookback_hours: 72\nstations:\n  - station_reference: "4009"\n  - station_reference: "4126"\n')
    with open(f"{base}/dim.csv", "w") as f:
        f.write("station_reference,station_label,river_name,threshold_m,typical_range_high\n4009,S4009,R,,3.6\n4126,S4126,R,,2.9\n")

    assert cli.main(["ingest", "--payloads", f"{base}/in", "--bronze", f"{base}/bronze", "--config", f"{base}/stations.yml",
                     "--run-ts", "2026-06-14T00:00:00Z", "--meta", f"{base}/ingest_meta.json"]) == 0
    ingest = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert ingest["rows_ingested"] == 16 and ingest["since"] == "2026-06-11T00:00:00Z"

    assert cli.main(["build", "--bronze", f"{base}/bronze", "--dim", f"{base}/dim.csv", "--out", f"{base}/pub",
                     "--as-of", "2026-06-14T00:00:00Z"]) == 0
    build = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert build["published"] is True and build["tests_passed"] == 11

    import hashlib

    rid = hashlib.md5(b"m-4009|2026-06-13T18:00:00Z").hexdigest()
    assert cli.main(["trace", "--root", f"{base}/pub", "--id", rid]) == 0
    tr = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert tr["reading_id"] == rid and tr["copies"] == 1 and tr["quality_flag"] == "ok"

    with open(f"{base}/st.json", "w") as f:
        f.write(json.dumps({"items": [{"stationReference": "1", "label": "Trent A", "stageScale": {"typicalRangeHigh": 2.5}},
                                      {"stationReference": "2", "label": "Soar B"}]}) + "\n")
    assert cli.main(["discover", "--stations", f"{base}/st.json"]) == 0
    found = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert [(s["station_reference"], s["typical_range_high"]) for s in found] == [("1", 2.5)]
