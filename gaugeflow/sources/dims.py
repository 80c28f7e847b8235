"""Station dimension and pinned-station configuration."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.schemas import DIM_STATIONS


def read_dim_csv(spark: SparkSession, path: str) -> DataFrame:
    """Dimension seed CSV with a declared schema: station references stay text."""
    return spark.read.schema(DIM_STATIONS).option("header", "true").csv(path)


def pinned_stations(df: DataFrame, refs: Iterable[str], col: str = "station_reference") -> DataFrame:
    """Rows of the configured stations only (a short literal list → ``In`` filter at the scan)."""
    return df.where(F.col(col).isin(list(refs)))


def restrict_to(df: DataFrame, stations: DataFrame, col: str = "station_reference") -> DataFrame:
    """Rows whose station is in a station table (semi join; AQE broadcasts it when small)."""
    return df.join(stations.select(col).distinct(), col, "left_semi")


def parse_station_config(text: str) -> dict:
    """Station configuration (``lookback_hours`` and ``stations: [{station_reference: …}]``).
    YAML when a YAML parser is installed, else JSON. A few lines: parsed on the driver."""
    try:
        import yaml
    except ImportError:  # pragma: no cover - JSON configs still work
        import json

        return json.loads(text)
    return yaml.safe_load(text) or {}


def read_station_config(spark: SparkSession, path: str) -> dict:
    from gaugeflow.plans.publish import read_text

    text = read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return parse_station_config(text)


def configured_refs(config: dict) -> list[str]:
    return [str(s["station_reference"]) for s in config.get("stations", [])]


def lookback_hours(config: dict, hours: int | None = None, default: int = 6) -> int:
    """Explicit hours win; none or 0 falls back to the configuration."""
    return int(hours or config.get("lookback_hours", default))
