"""Hand-made inputs: the two-station bronze fixture and edge rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.functions.keys import mint_reading_id
from gaugeflow.schemas import BRONZE, DIM_STATIONS

NOW = datetime(2026, 6, 14, 16, 15, 0)
MEASURE = "id/measures/{}-level-stage-i-15_min-mASD"


def iso(ts: datetime) -> str:
    return ts.strftime("%Y-%m-%dT%H:%M:%SZ")


def bronze_rows(rows: list[dict]) -> list[tuple]:
    out = []
    for r in rows:
        out.append(tuple(r.get(f.name) for f in BRONZE.fields))
    return out


def to_bronze(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rows → bronze with the key minted by the engine's own function."""
    df = spark.createDataFrame(bronze_rows(rows), BRONZE)
    return df.withColumn("reading_id", mint_reading_id("measure", "date_time"))


def reading(station: str, ts: datetime | None, value, ingested: datetime = NOW, **kw) -> dict:
    r = {
        "measure": kw.pop("measure", MEASURE.format(station)),
        "station_reference": station,
        "station_label": kw.pop("label", f"Station {station}"),
        "parameter": kw.pop("parameter", "level"),
        "qualifier": kw.pop("qualifier", "Stage"),
        "unit_name": "mASD",
        "date_time": iso(ts) if ts is not None else None,
        "value": None if value is None else str(value),
        "_ingested_at": iso(ingested),
        "_source_batch_id": kw.pop("batch", iso(ingested)),
    }
    r.update(kw)
    return r


def golden_bronze(spark: SparkSession) -> DataFrame:
    """2 stations x readings now, -24 h, -48 h with values 1.0, 1.1, 1.2."""
    rows = []
    for st in ("4009", "4126"):
        for i, v in enumerate((1.0, 1.1, 1.2)):
            rows.append(reading(st, NOW - timedelta(hours=24 * i), v))
    return to_bronze(spark, rows)


# Dimension seed of the fixture (station, label, river, threshold, typical high).
SEED = [
    ("4009", "Colwick", "River Trent", None, 3.6),
    ("4126", "Clifton Bridge", "River Trent", None, 2.9),
    ("4007", "Shardlow", "River Trent", None, 1.7),
    ("4022", "North Muskham", "River Trent", None, 3.3),
]


def seed_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED, DIM_STATIONS)
