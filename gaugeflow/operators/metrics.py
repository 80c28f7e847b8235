"""Interactive queries of the dashboard re-expressed as grouped aggregates:
series extent, slider bounds, live threshold re-flag, headline counts,
freshness and the run-metadata row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.config import STALE_MINUTES
from gaugeflow.functions.timefns import age_minutes


def series_extent(series: DataFrame, group: str = "station_reference") -> DataFrame:
    """Per group: first / last time, min / max value, last value, count."""
    return series.groupBy(group).agg(
        F.min("date_time_utc").alias("first_at"),
        F.max("date_time_utc").alias("last_at"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max_by(F.col("value"), F.struct("date_time_utc", "reading_id")).alias("last_value"),
        F.count(F.lit(1)).alias("n_points"),
    )


def extent_with_forecast(series: DataFrame, forecast: DataFrame, group: str = "station_reference") -> DataFrame:
    """Extent over observed points plus their forecast; the last observed
    point is the anchor the forecast line starts from."""
    obs = series.select(group, "date_time_utc", "value", "reading_id", F.lit(False).alias("is_fc"))
    fc = forecast.select(group, "date_time_utc", "value", F.lit(None).cast("string").alias("reading_id"), F.lit(True).alias("is_fc"))
    both = obs.unionByName(fc)
    return both.groupBy(group).agg(
        F.min("date_time_utc").alias("first_at"),
        F.max("date_time_utc").alias("last_at"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.max_by(F.col("value"), F.when(~F.col("is_fc"), F.struct("date_time_utc", "reading_id"))).alias("anchor_value"),
        F.max(F.when(~F.col("is_fc"), F.col("date_time_utc"))).alias("anchor_at"),
        F.count_if(~F.col("is_fc")).alias("n_observed"),
        F.count_if(F.col("is_fc")).alias("n_forecast"),
    )


def slider_bounds(extent: DataFrame, thresholds: DataFrame, group: str = "station_reference") -> DataFrame:
    """``lo = floor(min*10)/10``, ``hi = max(ceil(max*10)/10, th)``, the
    initial value is ``th`` clamped into ``[lo, hi]``; a missing threshold
    falls back to the series maximum."""
    j = extent.join(thresholds.select(group, "threshold"), group, "left")
    th = F.coalesce(F.col("threshold"), F.col("max_value"))
    lo = F.floor(F.col("min_value") * 10) / 10
    hi = F.greatest(F.ceil(F.col("max_value") * 10) / 10, th)
    return j.select(
        group,
        lo.cast("double").alias("slider_min"),
        hi.cast("double").alias("slider_max"),
        F.least(F.greatest(th, lo), hi).cast("double").alias("slider_value"),
    )


def thresholds_by_station(latest: DataFrame) -> DataFrame:
    """One threshold per station (stations with several measures share it)."""
    return latest.groupBy("station_reference").agg(F.max("threshold").alias("threshold"))


def reflag(series: DataFrame, threshold: float | Column, group: str = "station_reference") -> DataFrame:
    """Points strictly above ``threshold`` per group, and the total."""
    th = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return series.groupBy(group).agg(
        F.count_if(F.col("value") > th).alias("flagged"),
        F.count(F.lit(1)).alias("total"),
    )


def flag_points(series: DataFrame, threshold: float | Column) -> DataFrame:
    th = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return series.withColumn("flagged", F.col("value") > th)


def headline_counts(latest: DataFrame) -> DataFrame:
    """Rows of the latest table and how many are above their threshold
    (a null flag is not counted)."""
    return latest.agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.count_if(F.col("above_threshold")).alias("n_above"),
    )


def headline_ordered(latest: DataFrame) -> DataFrame:
    return latest.select("station_reference", "station_label", "latest_value", "change_24h", "above_threshold").orderBy(
        F.col("above_threshold").desc_nulls_last(), F.col("station_reference").asc_nulls_last(), F.col("latest_value").desc()
    )


def primary_series(series: DataFrame, primary: str) -> DataFrame:
    """Series of the primary station, else of the first station in
    ``station_reference`` order."""
    chosen = (
        series.select("station_reference")
        .distinct()
        .select(
            F.max(F.when(F.col("station_reference") == primary, F.col("station_reference"))).alias("p"),
            F.min("station_reference").alias("first"),
        )
        .select(F.coalesce("p", "first"))
    )
    # A scalar subquery: the equality reaches the Parquet scan at run time.
    return series.where(F.col("station_reference") == chosen.scalar())


def freshness(df: DataFrame, ts_col: str, now: datetime | None, group: str | None = None) -> DataFrame:
    """Age in minutes of the newest ``ts_col`` (per group) and the stale flag."""
    now_c = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    g = df.groupBy(group) if group else df.groupBy()
    last = g.agg(F.max(ts_col).alias("last_at"))
    age = age_minutes("last_at", now_c)
    return last.select(*([group] if group else []), "last_at", age.alias("age_minutes"), (age > STALE_MINUTES).alias("stale"))


def health(meta: DataFrame, now: datetime | None = None) -> DataFrame:
    """Dashboard health from a run-metadata row: status is ``stale`` when the
    last run is older than the limit, ``last-known-good`` otherwise (also when
    the last run time is unknown)."""
    now_c = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    age = age_minutes(F.col("last_run_utc").cast("timestamp_ntz"), now_c)
    stale = F.coalesce(age > STALE_MINUTES, F.lit(False))
    return meta.select(
        "*",
        age.alias("age_minutes"),
        stale.alias("stale"),
        F.when(stale, F.lit("stale")).otherwise(F.lit("last-known-good")).alias("health_status"),
    )


def heartbeat_health(spark, heartbeat_path: str, now: datetime | None = None) -> DataFrame:
    """Staleness of the landing heartbeat document; a missing heartbeat
    reads as unknown age (not stale), like a missing run time."""
    from pyspark.sql import types as T

    from gaugeflow.sources.meta import read_json_or_nulls

    schema = T.StructType(
        [
            T.StructField("last_ingest_utc", T.StringType()),
            T.StructField("rows", T.LongType()),
            T.StructField("blob", T.StringType()),
        ]
    )
    hb = read_json_or_nulls(spark, heartbeat_path, schema).withColumnRenamed("last_ingest_utc", "last_run_utc")
    return health(hb, now)
