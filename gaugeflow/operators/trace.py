"""Click-to-trace: bronze copies, silver row and gold row of given keys.

The keys come in as a DataFrame, so one key or millions are traced the same
way (keyed semi joins and one aggregate). A single literal key becomes an
``EqualTo`` filter that reaches the Parquet scan of each layer.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.config import SERIES_WINDOW_DAYS
from gaugeflow.functions.keys import sanitize_reading_id
from gaugeflow.functions.values import quality_flag
from gaugeflow.operators.gold import stage_rows, window_cutoff
from gaugeflow.operators.lineage import bronze_copy_rows
from gaugeflow.operators.silver import typed_readings

#: Which copy of a key silver keeps: the largest of these.
COPY_ORDER = ("ingested_at", "source_batch_id", "value")


def ids_frame(spark: SparkSession, reading_id: str) -> DataFrame:
    """One sanitised key (hex digits only; empty → no row)."""
    df = spark.range(1).select(sanitize_reading_id(F.lit(reading_id)).alias("reading_id"))
    return df.where(F.col("reading_id").isNotNull())


def trace(bronze: DataFrame, silver: DataFrame, series: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per key found in at least one layer."""
    ids = ids.select("reading_id").distinct()
    b = (
        bronze_copy_rows(bronze.join(ids, "reading_id", "left_semi"))
        .groupBy("reading_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("ingested_at").alias("first_ingested_at"),
            F.max("ingested_at").alias("last_ingested_at"),
        )
    )
    s = silver.join(ids, "reading_id", "left_semi").select(
        "reading_id",
        F.col("value").alias("silver_value"),
        "quality_flag",
        F.col("ingested_at").alias("kept_ingested_at"),
    )
    g = series.join(ids, "reading_id", "left_semi").select(
        "reading_id", "date_time_utc", F.col("value").alias("gold_value"), "unit_name"
    )
    j = ids.join(b, "reading_id", "left").join(s, "reading_id", "left").join(g, "reading_id", "left")
    found = F.col("copies").isNotNull() | F.col("quality_flag").isNotNull() | F.col("unit_name").isNotNull()
    return j.where(found).select(
        "reading_id",
        "date_time_utc",
        F.coalesce(F.col("copies"), F.lit(0)).cast("long").alias("copies"),
        "first_ingested_at",
        "last_ingested_at",
        "silver_value",
        "quality_flag",
        "kept_ingested_at",
        "gold_value",
        "unit_name",
    )


def clean_id(reading_id: str) -> str | None:
    """The text form of :func:`sanitize_reading_id` for one parameter value."""
    import re

    cleaned = re.sub(r"(?i)[^a-f0-9]", "", reading_id or "")
    return cleaned or None


def trace_by_id(bronze: DataFrame, silver: DataFrame, series: DataFrame, reading_id: str) -> DataFrame:
    """One key given as text: each layer gets an equality filter on the key,
    which reaches its Parquet scan (``EqualTo``) instead of a join."""
    rid = clean_id(reading_id)
    spark = bronze.sparkSession
    if rid is None:
        return trace(bronze, silver, series, spark.range(0).select(F.lit(None).cast("string").alias("reading_id")))
    key = F.col("reading_id") == F.lit(rid)
    ids = spark.range(1).select(F.lit(rid).alias("reading_id"))
    return trace(bronze.where(key), silver.where(key), series.where(key), ids)


def trace_records(bronze: DataFrame, reading_id: str) -> DataFrame:
    """The bronze copies of one key, oldest ingest first."""
    rid = sanitize_reading_id(F.lit(reading_id))
    return bronze_copy_rows(bronze.where(F.col("reading_id") == rid)).orderBy("ingested_at", "source_batch_id")


def most_copied_plotted_key(bronze: DataFrame, series: DataFrame) -> DataFrame:
    """The plotted key with the most bronze copies (ties: smallest key) —
    a data-derived key to trace."""
    copies = bronze.join(series.select("reading_id"), "reading_id", "left_semi").groupBy("reading_id").count()
    return copies.orderBy(F.col("count").desc(), F.col("reading_id").asc()).limit(1).select("reading_id")


def most_copied_in_one_pass(bronze: DataFrame, as_of: datetime | None = None, days: int = SERIES_WINDOW_DAYS) -> DataFrame:
    """The same key without the layers: one aggregate over bronze counts the copies of a
    key and keeps the one that silver would, which says whether it is plotted."""
    typed = typed_readings(bronze)
    payload = [c for c in typed.columns if c not in ("reading_id", *COPY_ORDER)]
    kept = typed.groupBy("reading_id").agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct(*COPY_ORDER, *payload)).alias("_k"))
    flagged = kept.select("reading_id", "copies", "_k.*").withColumn("quality_flag", quality_flag("value"))
    plotted = stage_rows(flagged).where(F.col("date_time_utc") >= window_cutoff(as_of, days))
    return plotted.orderBy(F.col("copies").desc(), F.col("reading_id").asc()).limit(1).select("reading_id")
