"""Command line: ``python -m gaugeflow.cli <command> …``.

  ingest    landed payload files → bronze (lookback from config or --hours)
  build     bronze → silver → gold → checks → gated publish
  discover  station documents → candidate stations (JSON lines)
  trace     one reading key across the published layers (JSON)

Argument parsing only; every command runs the Spark plans of this package on
the active session (``spark-submit`` provides it on a cluster).
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from gaugeflow.session import build_session

    active = SparkSession.getActiveSession()
    if active is not None:
        from gaugeflow.session import configure

        return configure(active)
    return build_session()


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)


def _parse_ts(text: str | None) -> datetime:
    if not text:
        return _now()
    return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None)


def cmd_ingest(spark: SparkSession, a: argparse.Namespace) -> dict:
    from gaugeflow.plans.ingest import ingest_run
    from gaugeflow.sources.dims import read_station_config

    config = read_station_config(spark, a.config) if a.config else {}
    r = ingest_run(
        spark, a.payloads, a.bronze, config, _parse_ts(a.run_ts), hours=a.hours,
        meta_path=a.meta, layout=a.layout,
    )
    return {"run": r.run_ts, "since": r.since, "rows_ingested": r.rows}


def cmd_build(spark: SparkSession, a: argparse.Namespace) -> dict:
    from gaugeflow.plans.pipeline import run_pipeline
    from gaugeflow.sources.bronze import read_bronze
    from gaugeflow.sources.dims import read_dim_csv

    as_of = _parse_ts(a.as_of)
    r = run_pipeline(
        spark, "", a.out, as_of=as_of, bronze_as_of=as_of, bronze=read_bronze(spark, a.bronze), dim=read_dim_csv(spark, a.dim),
        layout=a.layout,
    )
    return {"run_id": r.run_id, "folder": r.folder, "published": r.published, **r.summary}


def cmd_discover(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    from gaugeflow.sources.payloads import discover_stations, read_station_payloads

    found = discover_stations(read_station_payloads(spark, a.stations), search=a.search, town=a.town)
    return [row.asDict() for row in found.toLocalIterator()]


def cmd_trace(spark: SparkSession, a: argparse.Namespace) -> list[dict]:
    from gaugeflow.operators.trace import trace_by_id
    from gaugeflow.plans.publish import current_version

    folder = current_version(spark, a.root)
    if folder is None:
        raise SystemExit(f"nothing published under {a.root}")
    bronze = spark.read.parquet(f"{folder}/bronze_window")
    silver = spark.read.parquet(f"{folder}/silver")
    series = spark.read.parquet(f"{folder}/gold_series")
    return [{k: (str(v) if isinstance(v, datetime) else v) for k, v in r.asDict().items()}
            for r in trace_by_id(bronze, silver, series, a.id).collect()]


#: What the date folders of bronze hold.
LAYOUTS = ("reading", "run")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gaugeflow")
    sub = p.add_subparsers(dest="command", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--payloads", required=True)
    i.add_argument("--bronze", required=True)
    i.add_argument("--config")
    i.add_argument("--hours", type=int)
    i.add_argument("--meta")
    i.add_argument("--run-ts")
    i.add_argument("--layout", choices=LAYOUTS, default="reading")
    b = sub.add_parser("build")
    b.add_argument("--bronze", required=True)
    b.add_argument("--dim", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--as-of")
    b.add_argument("--layout", choices=LAYOUTS, default="reading")
    d = sub.add_parser("discover")
    d.add_argument("--stations", required=True)
    d.add_argument("--search", default="Trent")
    d.add_argument("--town")
    t = sub.add_parser("trace")
    t.add_argument("--root", required=True)
    t.add_argument("--id", required=True)
    return p


COMMANDS = {"ingest": cmd_ingest, "build": cmd_build, "discover": cmd_discover, "trace": cmd_trace}


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    out = COMMANDS[a.command](_session(), a)
    for item in out if isinstance(out, list) else [out]:
        print(json.dumps(item, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
