"""Batch ingest run: landed payload files → bronze, plus run metadata.

payload scan → flatten (key minted) → configured stations only → readings
strictly after ``since`` → stamp → append to bronze by reading date → heartbeat and ingest
metadata. Rows are counted by the write itself (an ``Observation``), so nothing
is read back; both documents are written even when no row arrived, and no
reading is left out of append-only bronze.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.sinks.landing import land_bronze, write_heartbeat, write_ingest_meta
from gaugeflow.sources import dims, payloads


@dataclass
class IngestResult:
    run_ts: str
    since: str
    rows: int


def _iso(ts: datetime) -> str:
    return ts.strftime("%Y-%m-%dT%H:%M:%SZ")


def ingest_run(
    spark: SparkSession,
    payload_path: str,
    bronze_root: str,
    config: dict,
    run_ts: datetime,
    hours: int | None = None,
    meta_path: str | None = None,
    stations: DataFrame | None = None,
    layout: str = "reading",
) -> IngestResult:
    """``layout`` lands by ``reading`` or by ``run`` date. ``stations`` (a station table) restricts by semi join instead of the
    configured list, for station sets too large to list in a config."""
    since = _iso(run_ts - timedelta(hours=dims.lookback_hours(config, hours)))
    run_text = _iso(run_ts)
    flat = payloads.flatten_readings(payloads.read_reading_payloads(spark, payload_path))
    refs = dims.configured_refs(config)
    if stations is not None:
        flat = dims.restrict_to(flat, stations)
    elif refs:
        flat = dims.pinned_stations(flat, refs)
    # exclusive lower bound on the reading time; rows without a time are kept (silver drops them)
    recent = flat.where(F.col("date_time").isNull() | (F.col("date_time").cast("timestamp_ntz") > F.lit(since).cast("timestamp_ntz")))
    rows = land_bronze(recent, bronze_root, run_text, by=layout)
    write_heartbeat(spark, bronze_root, run_text, rows, f"batch={run_text}")
    if meta_path:
        n_stations = stations.select("station_reference").distinct().count() if stations is not None else len(refs)
        write_ingest_meta(spark, meta_path, run_text, since, rows, n_stations)
    return IngestResult(run_text, since, rows)
