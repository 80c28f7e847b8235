"""gaugeflow: a Spark-native medallion engine for sensor readings.

Every function takes and returns DataFrames; nothing runs until an action.
"""

from gaugeflow.operators.asof import asof_every, asof_lag
from gaugeflow.operators.checks import DEFAULT_CHECKS, Check, run_checks, summarize, test_stats
from gaugeflow.operators.forecast import forecast_model, forecast_points, series_with_forecast
from gaugeflow.operators.gold import gold_latest, gold_series, ordered_series, sort_series_for_write, stage_rows
from gaugeflow.operators.lineage import lineage_flat, lineage_json, lineage_nested, lineage_records
from gaugeflow.operators.metrics import (
    extent_with_forecast,
    flag_points,
    freshness,
    headline_counts,
    headline_ordered,
    health,
    primary_series,
    reflag,
    series_extent,
    slider_bounds,
)
from gaugeflow.operators.silver import build_silver, dedupe_keep_latest_agg, dedupe_keep_latest_window
from gaugeflow.operators.trace import trace, trace_by_id, trace_records
from gaugeflow.session import build_session, configure, materialize
from gaugeflow.sources.bronze import read_bronze
from gaugeflow.sources.payloads import discover_stations, flatten_readings

__all__ = [
    "Check",
    "DEFAULT_CHECKS",
    "asof_every",
    "asof_lag",
    "build_session",
    "build_silver",
    "configure",
    "dedupe_keep_latest_agg",
    "dedupe_keep_latest_window",
    "discover_stations",
    "extent_with_forecast",
    "flag_points",
    "flatten_readings",
    "forecast_model",
    "forecast_points",
    "freshness",
    "gold_latest",
    "gold_series",
    "headline_counts",
    "headline_ordered",
    "health",
    "lineage_flat",
    "lineage_json",
    "lineage_nested",
    "lineage_records",
    "materialize",
    "ordered_series",
    "primary_series",
    "read_bronze",
    "reflag",
    "run_checks",
    "series_extent",
    "series_with_forecast",
    "slider_bounds",
    "sort_series_for_write",
    "stage_rows",
    "summarize",
    "test_stats",
    "trace",
    "trace_by_id",
    "trace_records",
]
