"""Gold tables: the chart series and the latest value per measure."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.config import ASOF_LAG, SERIES_WINDOW_DAYS, STAGE_FLAG, STAGE_PARAMETER, STAGE_QUALIFIER
from gaugeflow.operators.asof import asof_lag

SERIES_COLUMNS = (
    "reading_id",
    "station_reference",
    "station_label",
    "parameter",
    "qualifier",
    "date_time_utc",
    "value",
    "unit_name",
)

LATEST_COLUMNS = (
    "reading_id",
    "station_reference",
    "station_label",
    "measure",
    "unit_name",
    "latest_at",
    "latest_value",
    "value_24h_ago",
    "change_24h",
    "threshold",
    "above_threshold",
)


def stage_rows(silver: DataFrame) -> DataFrame:
    """level / Stage / ok rows; the three equalities reach the Parquet scan."""
    return silver.where(
        (F.col("parameter") == STAGE_PARAMETER)
        & (F.col("qualifier") == STAGE_QUALIFIER)
        & (F.col("quality_flag") == STAGE_FLAG)
    )


def window_cutoff(as_of: datetime | None, days: int) -> F.Column:
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    return now - F.expr(f"INTERVAL {int(days)} DAYS")


def gold_series(silver: DataFrame, as_of: datetime | None = None, days: int = SERIES_WINDOW_DAYS) -> DataFrame:
    """Stage rows of the last ``days`` days (inclusive cutoff). When silver
    is stored partitioned by ``reading_date`` (= the date of
    ``date_time_utc``), the same bound on that column prunes every older
    partition at planning time; the exact timestamp bound still decides."""
    cutoff = window_cutoff(as_of, days)
    rows = stage_rows(silver).where(F.col("date_time_utc") >= cutoff)
    if "reading_date" in silver.columns:
        rows = rows.where(F.col("reading_date") >= F.to_date(cutoff))
    return rows.select(*SERIES_COLUMNS)


def sort_series_for_write(series: DataFrame, partitions: int | None = None) -> DataFrame:
    """Physical order by station then time: range-partition on (station,
    time) and sort inside each partition, so Parquet row groups get tight
    min/max statistics. Time is part of the range key, so a station with a
    large share of the rows is spread over several ranges instead of one task."""
    keys = ["station_reference", "date_time_utc", "reading_id"]
    keyed = series.repartitionByRange(partitions, *keys) if partitions else series.repartitionByRange(*keys)
    return keyed.sortWithinPartitions(*keys)


def threshold_of(dim_threshold: str = "threshold_m", dim_typical: str = "typical_range_high") -> F.Column:
    return F.coalesce(F.col(dim_threshold), F.col(dim_typical))


def gold_latest(silver: DataFrame, dim: DataFrame, lag: str = ASOF_LAG, tolerance: str | None = None) -> DataFrame:
    """Latest stage reading per measure, its value ``lag`` earlier (as-of,
    inclusive, no tolerance by default), the rounded change and the
    threshold flag from the station dimension (left join)."""
    stage = stage_rows(silver)
    latest = asof_lag(
        stage,
        key="measure",
        ts="date_time_utc",
        value="value",
        lag=lag,
        tie="reading_id",
        cols=["reading_id", "station_reference", "station_label", "unit_name", "date_time_utc", "value"],
        tolerance=tolerance,
        out_col="value_24h_ago",
    )
    d = dim.select("station_reference", threshold_of().alias("threshold"))
    j = latest.join(d, "station_reference", "left")
    return j.select(
        "reading_id",
        "station_reference",
        "station_label",
        "measure",
        "unit_name",
        F.col("date_time_utc").alias("latest_at"),
        F.col("value").alias("latest_value"),
        "value_24h_ago",
        F.round(F.col("value") - F.col("value_24h_ago"), 3).alias("change_24h"),
        "threshold",
        (F.col("value") > F.col("threshold")).alias("above_threshold"),
    )


def ordered_series(series: DataFrame) -> DataFrame:
    """Series by time (ties by key) — a global sort, for rendering a bounded window."""
    return series.orderBy(F.col("date_time_utc").asc_nulls_last(), F.col("reading_id").asc_nulls_last())
