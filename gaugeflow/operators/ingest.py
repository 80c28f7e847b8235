"""Landing-side operators: lookback window, newest-N cap per station, batch
stamps, partition dates and per-day row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.timefns import batch_name


def lookback_since(df: DataFrame, since: str, ts: str = "date_time_utc") -> DataFrame:
    """Readings strictly after ``since`` (ISO text, exclusive bound)."""
    return df.where(F.col(ts) > F.lit(since).cast("timestamp_ntz"))


def newest_n(df: DataFrame, n: int, group: str = "station_reference", ts: str = "date_time_utc", tie: str = "reading_id") -> DataFrame:
    """Newest ``n`` rows per group (newest first, ties by key). Spark plans
    this as a partial ``WindowGroupLimit`` before the shuffle, so at most
    ``n`` rows per group leave each input split."""
    w = Window.partitionBy(group).orderBy(F.col(ts).desc_nulls_last(), F.col(tie).desc_nulls_last())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def stamp_batch(df: DataFrame, run_ts_text: str | Column) -> DataFrame:
    """Add ``_ingested_at`` and ``_source_batch_id`` (the same run stamp)."""
    stamp = F.lit(run_ts_text) if isinstance(run_ts_text, str) else run_ts_text
    return df.withColumn("_ingested_at", stamp).withColumn("_source_batch_id", stamp)


def reading_date(date_time_text: str = "date_time") -> Column:
    """Partition date of a reading (null when the reading time is null)."""
    return F.to_date(F.col(date_time_text).cast("timestamp_ntz"))


def with_partition_columns(df: DataFrame, run_ts_text: str | Column, by: str = "reading") -> DataFrame:
    """``dt`` (reading date, or run date when ``by='run'``) and ``batch``."""
    stamp = F.lit(run_ts_text) if isinstance(run_ts_text, str) else run_ts_text
    dt = reading_date() if by == "reading" else F.to_date(stamp.cast("timestamp_ntz"))
    return df.withColumn("dt", dt).withColumn("batch", batch_name(stamp))


def rows_per_day(bronze: DataFrame) -> DataFrame:
    """Bronze rows per reading date (null dates form their own group)."""
    return bronze.groupBy(reading_date().alias("dt")).agg(F.count(F.lit(1)).alias("rows"))


def bronze_window(bronze: DataFrame, as_of, days: int = 90, by: str = "reading") -> DataFrame:
    """Bronze rows whose reading time is within ``days`` of ``as_of``
    (inclusive; the text time is cast in the predicate, so bad text is an
    error as in the strict cast). With a ``dt`` partition column that holds the reading
    date, the bound ``dt >= date(cutoff)`` prunes older folders. In the run-date
    layout (``by='run'``) a reading may be stamped after its run, so no folder is left out."""
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    cutoff = now - F.expr(f"INTERVAL {int(days)} DAYS")
    rows = bronze.where(F.col("date_time").cast("timestamp_ntz") >= cutoff)
    if "dt" in bronze.columns and by == "reading":
        rows = rows.where(F.col("dt") >= F.to_date(cutoff))
    return rows
