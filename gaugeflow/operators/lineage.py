"""Lineage: for each plotted reading, its bronze copies, the silver row kept
and the gold value.

Everything is keyed joins and aggregates on ``reading_id``. The per-key
copy summary (count, first / last ingest) is a map-side-combined aggregate
that comes before any join, so a key with a huge number of copies never lands whole in one task. The
raw copies themselves are kept as rows (:func:`lineage_records`), ordered on
write by a range partitioning on ``(reading_id, ingested_at)``; they are not
gathered into one array per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.functions.timefns import to_ntz, ts_text
from gaugeflow.functions.values import try_double


def bronze_copy_rows(bronze: DataFrame) -> DataFrame:
    """Bronze copies with typed value and ingest stamp (raw text kept)."""
    return bronze.select(
        "reading_id",
        try_double("value", bronze.schema["value"].dataType).alias("value"),
        to_ntz("_ingested_at").alias("ingested_at"),
        F.col("_source_batch_id").alias("source_batch_id"),
    )


def copy_summary(bronze: DataFrame) -> DataFrame:
    """Per key: number of bronze copies and first / last ingest time."""
    return (
        bronze_copy_rows(bronze)
        .groupBy("reading_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("ingested_at").alias("first_ingested_at"),
            F.max("ingested_at").alias("last_ingested_at"),
        )
    )


def semi_in(df: DataFrame, keys: DataFrame, key: str = "reading_id") -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (``IN (subquery)``)."""
    return df.join(keys.select(key), key, "left_semi")


def dated(bronze: DataFrame, series: DataFrame, by: str = "reading") -> DataFrame:
    """Bronze rows that may be copies of plotted keys.

    With a ``dt`` partition column, folders before the first plotted reading's
    date are left out by a scalar subquery, which Spark evaluates before
    listing partitions. That is exact where ``dt`` is the reading date (every copy of
    a key shares it); in the run-date layout (``by='run'``) a reading may be
    stamped after its run date, so all folders are read."""
    if "dt" in bronze.columns and by == "reading":
        first = series.agg(F.min("date_time_utc")).scalar()
        bronze = bronze.where(F.col("dt").isNull() | (F.col("dt") >= F.to_date(first)))
    return bronze


def bronze_of_series(bronze: DataFrame, series: DataFrame, by: str = "reading") -> DataFrame:
    """Bronze copies of plotted keys, one row per copy."""
    return semi_in(dated(bronze, series, by), series)


def lineage_flat(bronze: DataFrame, silver: DataFrame, series: DataFrame, by: str = "reading") -> DataFrame:
    """One row per gold-series key: copies, ingest span, kept silver row, gold value."""
    gold = series.select(
        "reading_id", "station_reference", "station_label", "date_time_utc", F.col("value").alias("gold_value"), "unit_name"
    )
    # Copies are combined before the join, map-side first: a key with very many
    # copies reaches it as one row. The left joins keep the plotted keys alone, so the
    # series is read once here (and once more for the first date, where that prunes).
    copies = copy_summary(dated(bronze, series, by))
    kept = silver.select(
        "reading_id",
        F.col("value").alias("silver_value"),
        "quality_flag",
        F.col("ingested_at").alias("kept_ingested_at"),
    )
    return (
        gold.join(copies, "reading_id", "left")
        .join(kept, "reading_id", "left")
        .select(
            "reading_id",
            "station_reference",
            "station_label",
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
    )


def lineage_nested(bronze: DataFrame, silver: DataFrame, series: DataFrame, by: str = "reading") -> DataFrame:
    """The lineage document per key as nested structs; a missing silver row
    gives a null ``silver`` struct. Time values are text as in the document."""
    flat = lineage_flat(bronze, silver, series, by)
    silver_part = F.when(
        F.col("quality_flag").isNotNull(),
        F.struct(
            F.col("silver_value").alias("value"),
            F.col("quality_flag"),
            ts_text("kept_ingested_at").alias("ingested_at"),
        ),
    )
    return flat.select(
        "reading_id",
        F.struct(
            "reading_id",
            "station_reference",
            "station_label",
            ts_text("date_time_utc").alias("date_time_utc"),
            F.struct(
                F.col("copies").cast("int").alias("copies"),
                ts_text("first_ingested_at").alias("first_ingested_at"),
                ts_text("last_ingested_at").alias("last_ingested_at"),
            ).alias("bronze"),
            silver_part.alias("silver"),
            F.struct(F.col("gold_value").alias("value"), "unit_name").alias("gold"),
        ).alias("lineage"),
    )


def lineage_records(bronze: DataFrame, series: DataFrame, by: str = "reading") -> DataFrame:
    """Raw bronze copies of every plotted key, one row per copy."""
    return bronze_copy_rows(bronze_of_series(bronze, series, by))


def sort_records_for_write(records: DataFrame, partitions: int | None = None) -> DataFrame:
    """Oldest-first copies per key on disk; range bounds include the ingest
    time, so a key with many copies spans several partitions."""
    keys = ["reading_id", "ingested_at"]
    keyed = records.repartitionByRange(partitions, *keys) if partitions else records.repartitionByRange(*keys)
    return keyed.sortWithinPartitions(*keys)


def lineage_json(nested: DataFrame) -> DataFrame:
    """``(reading_id, json)`` with nulls kept, for a keyed document store."""
    return nested.select("reading_id", F.to_json("lineage", {"ignoreNullFields": "false"}).alias("json"))
