"""Declared schemas of every layer. Nothing downstream relies on inference."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
TS = T.TimestampNTZType()

BRONZE = T.StructType(
    [
        T.StructField("reading_id", S),
        T.StructField("measure", S),
        T.StructField("station_reference", S),
        T.StructField("station_label", S),
        T.StructField("parameter", S),
        T.StructField("qualifier", S),
        T.StructField("unit_name", S),
        T.StructField("date_time", S),
        # Read as text: files may carry it as double, text or all-null.
        T.StructField("value", S),
        T.StructField("_ingested_at", S),
        T.StructField("_source_batch_id", S),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("reading_id", S),
        T.StructField("measure", S),
        T.StructField("station_reference", S),
        T.StructField("station_label", S),
        T.StructField("parameter", S),
        T.StructField("qualifier", S),
        T.StructField("unit_name", S),
        T.StructField("date_time_utc", TS),
        T.StructField("value", D),
        T.StructField("quality_flag", S),
        T.StructField("ingested_at", TS),
        T.StructField("source_batch_id", S),
        T.StructField("silver_built_at", TS),
    ]
)

GOLD_SERIES = T.StructType(
    [
        T.StructField("reading_id", S),
        T.StructField("station_reference", S),
        T.StructField("station_label", S),
        T.StructField("parameter", S),
        T.StructField("qualifier", S),
        T.StructField("date_time_utc", TS),
        T.StructField("value", D),
        T.StructField("unit_name", S),
    ]
)

GOLD_LATEST = T.StructType(
    [
        T.StructField("reading_id", S),
        T.StructField("station_reference", S),
        T.StructField("station_label", S),
        T.StructField("measure", S),
        T.StructField("unit_name", S),
        T.StructField("latest_at", TS),
        T.StructField("latest_value", D),
        T.StructField("value_24h_ago", D),
        T.StructField("change_24h", D),
        T.StructField("threshold", D),
        T.StructField("above_threshold", T.BooleanType()),
    ]
)

DIM_STATIONS = T.StructType(
    [
        T.StructField("station_reference", S),
        T.StructField("station_label", S),
        T.StructField("river_name", S),
        T.StructField("threshold_m", D),
        T.StructField("typical_range_high", D),
    ]
)

# Raw reading payload: one document per fetch, ``items`` holds readings whose
# ``measure`` is an object or a bare URI string, so it is kept as JSON text.
READING_PAYLOAD = T.StructType(
    [
        T.StructField("requested_station", S),
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("measure", S),
                        T.StructField("dateTime", S),
                        T.StructField("value", D),
                    ]
                )
            ),
        ),
    ]
)

# Station metadata payload; ``stageScale`` is an object, a URI or absent.
STATION_PAYLOAD = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("stationReference", S),
                        T.StructField("label", S),
                        T.StructField("riverName", S),
                        T.StructField("town", S),
                        T.StructField("lat", D),
                        T.StructField("long", D),
                        T.StructField("status", S),
                        T.StructField("stageScale", S),
                    ]
                )
            ),
        )
    ]
)

DQ_RESULT = T.StructType(
    [
        T.StructField("test_id", S),
        T.StructField("model", S),
        T.StructField("column_name", S),
        T.StructField("test_type", S),
        T.StructField("severity", S),
        T.StructField("failures", T.LongType()),
        T.StructField("status", S),
    ]
)
