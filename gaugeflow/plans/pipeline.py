"""End-to-end batch run: bronze → silver → gold → checks → gated publish.

Silver is written once and read back, so every gold table, check and
artifact starts from the materialised layer (its lineage is cut there and a
lost executor recomputes from Parquet, not from bronze). All artifacts are
written as distributed datasets; the only value brought to the driver is the
one-row check summary that decides the gate.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.config import BRONZE_EXPORT_DAYS
from gaugeflow.operators import checks, dashboard, forecast, gold, ingest, lineage, metrics, silver
from gaugeflow.plans import publish as pub
from gaugeflow.sources import derived
from gaugeflow.sources.meta import INGEST_META, read_json_or_nulls


@dataclass
class RunResult:
    run_id: str
    folder: str
    published: bool
    summary: dict


def _materialise(spark: SparkSession, df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    w = df.write.mode("errorifexists")
    if partition_by:
        # Rows of one folder meet in few tasks; a large folder is split by AQE.
        w = df.hint("rebalance", partition_by).write.mode("errorifexists").partitionBy(partition_by)
    pub.key_index(w, df).parquet(path)
    return spark.read.parquet(path)


def build_layers(spark: SparkSession, bronze: DataFrame, dim: DataFrame, folder: str, as_of: datetime):
    # Silver is stored by reading date: windowed consumers prune old dates.
    s = silver.build_silver(bronze, as_of).withColumn("reading_date", F.to_date("date_time_utc"))
    s = _materialise(spark, s, f"{folder}/silver", partition_by="reading_date")
    # Both gold tables read only silver: build them side by side.
    series, latest = pub.run_concurrently(
        [
            lambda: _materialise(spark, gold.sort_series_for_write(gold.gold_series(s, as_of)), f"{folder}/gold_series"),
            lambda: _materialise(spark, gold.gold_latest(s, dim), f"{folder}/gold_station_latest"),
        ]
    )
    return s, series, latest


def run_pipeline(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    as_of: datetime | None = None,
    bronze_as_of: datetime | None = None,
    bronze: DataFrame | None = None,
    dim: DataFrame | None = None,
    ingest_meta: str | None = None,
    layout: str = "reading",
) -> RunResult:
    """``layout`` says what ``dt`` of bronze holds, the ``reading`` or the ``run`` date. Clocks default to now (UTC). ``ingest_meta`` is the document of the last
    ingest run, whose time and row count go into the run metadata (nulls when
    there is none)."""
    now = datetime.now(UTC).replace(tzinfo=None)
    as_of, bronze_as_of = as_of or now, bronze_as_of or now
    run_id = f"run-{uuid.uuid4().hex[:12]}"
    folder = pub.version_path(root, run_id)
    bronze = bronze if bronze is not None else derived.bronze(spark, sf_dir)
    dim = dim if dim is not None else derived.stations(spark, sf_dir)

    s, series, latest = build_layers(spark, bronze, dim, folder, as_of)
    results = checks.run_checks({"silver": s, "gold_series": series, "gold_station_latest": latest, "dim_stations": dim})
    results = _materialise(spark, results, f"{folder}/checks")
    summary_row = checks.summarize(results).first()  # one row: the gate decision
    summary = summary_row.asDict()

    fc = forecast.forecast_points(series, group="station_reference")
    bronze_window = ingest.bronze_window(bronze, bronze_as_of, BRONZE_EXPORT_DAYS, layout)
    meta = (
        (read_json_or_nulls(spark, ingest_meta, INGEST_META) if ingest_meta else spark.createDataFrame([(None,) * len(INGEST_META)], INGEST_META))
        .select(
            F.col("last_ingest_utc").cast("timestamp_ntz").alias("last_run_utc"),
            "rows_ingested",
            s.agg(F.count(F.lit(1))).scalar().alias("silver_rows"),
            latest.agg(F.count(F.lit(1))).scalar().alias("stations"),
            latest.agg(F.count_if(F.col("above_threshold"))).scalar().alias("above_threshold"),
            F.lit(summary["tests_passed"]).cast("long").alias("tests_passed"),
            F.lit(summary["tests_total"]).cast("long").alias("tests_total"),
            F.lit("ok" if summary["publishable"] else "failed").alias("status"),
        )
    )
    artifacts = {
        "forecast": fc,
        "bronze_window": bronze_window,
        "lineage": lineage.lineage_json(lineage.lineage_nested(bronze, s, series, layout)),
        "lineage_records": lineage.sort_records_for_write(lineage.lineage_records(bronze, series, layout)),
        "stations": latest,
        "series": series.select("station_reference", "station_label", "date_time_utc", "value", "reading_id"),
        "series_extent": metrics.series_extent(series),
        "run_meta": pub.run_meta_document(meta),
        "dashboard": dashboard.station_documents(series, fc),
    }
    documents = ("run_meta", "stations", "forecast", "series", "dashboard")
    pub.write_artifacts(artifacts, folder, formats=dict.fromkeys(documents, "json"))
    pub.write_text(spark, f"{folder}/dashboard_header.json", json.dumps(pub.dashboard_header()))
    published = pub.publish(spark, root, run_id, bool(summary["publishable"]))
    return RunResult(run_id, folder, published, summary)
