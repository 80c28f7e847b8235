"""Dashboard documents: per station its ordered points, forecast and method text.

A station's points are cut into numbered chunks of a fixed number of points, one document
each, so no document grows with the series. Chunk numbers come from counts at two
levels: points are range-partitioned on (station, time, key), numbered inside each
(range, station), and moved on by the counts of the station's earlier ranges. No
task holds a station.

Defined cases: points without a station form a document series of their own; points without a
time stand first; ties in time are ordered by key; the forecast (bounded by its
horizon) is in the first chunk and is an empty list where there is none; an empty series
gives no documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.config import FORECAST_METHOD
from gaugeflow.functions.timefns import ts_text
from gaugeflow.session import materialize

CHUNK_POINTS = 1000


def _station_key(station: Column | str) -> Column:
    """The station as a key that is never null."""
    c = F.col(station) if isinstance(station, str) else station
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def numbered_points(series: DataFrame, ranges: int | None = None) -> DataFrame:
    """The series with ``_key``, ``position`` (from 0, by time, in the station) and ``total``."""
    rows = series.select(
        _station_key("station_reference").alias("_key"), "station_reference", "station_label", "date_time_utc", "value", "reading_id"
    )
    order = ["_key", "date_time_utc", "reading_id"]
    ranged = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "dashboard-ranges")
    counts = ranged.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_n"))
    station = Window.partitionBy("_key")
    earlier = station.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per (range, station): a station has at most as many as there are ranges.
    offsets = counts.select(
        "_key", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"), F.sum("_n").over(station).alias("total")
    )
    inside = Window.partitionBy("_range", "_key").orderBy("date_time_utc", "reading_id")
    numbered = ranged.withColumn("_row", F.row_number().over(inside))
    placed = numbered.join(offsets, ["_range", "_key"])
    return placed.withColumn("position", F.col("_offset") + F.col("_row") - 1).drop("_range", "_row", "_offset")


def station_documents(
    series: DataFrame, forecast: DataFrame, chunk_points: int = CHUNK_POINTS, ranges: int | None = None
) -> DataFrame:
    """One row per (station, chunk): ``station_reference, chunk, chunks, first_position,
    series, forecast, forecast_method``; written as JSON, a row is a line."""
    points = numbered_points(series, ranges).withColumn("chunk", F.floor(F.col("position") / chunk_points).cast("int"))
    point = F.struct("position", "station_label", ts_text("date_time_utc").alias("date_time_utc"), "value", "reading_id")
    chunks = points.groupBy("_key", "chunk").agg(
        F.first("station_reference").alias("station_reference"),
        F.ceil(F.first("total") / chunk_points).cast("int").alias("chunks"),
        F.min("position").alias("first_position"),
        F.array_sort(F.collect_list(point)).alias("_points"),  # at most chunk_points
    )
    step = F.struct("k", ts_text("date_time_utc").alias("date_time_utc"), "value", "kind")
    ahead = forecast.groupBy(_station_key("station_reference").alias("_key")).agg(F.array_sort(F.collect_list(step)).alias("_ahead"))
    ahead = ahead.select("_key", F.lit(0).alias("chunk"), F.transform("_ahead", lambda s: s.dropFields("k")).alias("forecast"))
    empty = F.array().cast(ahead.schema["forecast"].dataType)
    return chunks.join(ahead, ["_key", "chunk"], "left").select(
        "station_reference",
        "chunk",
        "chunks",
        "first_position",
        F.transform("_points", lambda p: p.dropFields("position")).alias("series"),
        F.coalesce("forecast", empty).alias("forecast"),
        F.lit(FORECAST_METHOD).alias("forecast_method"),
    )
