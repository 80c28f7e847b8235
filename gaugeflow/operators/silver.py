"""Silver: typed, keyed, deduplicated and quality-flagged readings.

One shuffle, on ``reading_id``. Both dedupe forms combine on the map side
before that shuffle (the window form through Spark's partial
``WindowGroupLimit``, the aggregate form through partial aggregation), so a
key with very many copies is cut down to one row per input split before it
moves; no task ever holds all copies of a hot key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.functions.timefns import to_ntz
from gaugeflow.functions.values import quality_flag, try_double

SILVER_COLUMNS = (
    "reading_id",
    "measure",
    "station_reference",
    "station_label",
    "parameter",
    "qualifier",
    "unit_name",
    "date_time_utc",
    "value",
    "quality_flag",
    "ingested_at",
    "source_batch_id",
)


def typed_readings(bronze: DataFrame) -> DataFrame:
    """Project bronze to typed columns and drop rows lacking a key part."""
    value_type = bronze.schema["value"].dataType
    return bronze.where(F.col("measure").isNotNull() & F.col("date_time").isNotNull()).select(
        "reading_id",
        "measure",
        "station_reference",
        "station_label",
        "parameter",
        "qualifier",
        "unit_name",
        to_ntz("date_time").alias("date_time_utc"),
        try_double("value", value_type).alias("value"),
        to_ntz("_ingested_at").alias("ingested_at"),
        F.col("_source_batch_id").alias("source_batch_id"),
    )


def latest_copy_order(extra: tuple[str, ...] = ()) -> list[Column]:
    """Which copy of a key wins: newest ingest, then the later batch, then the
    larger value (nulls last). The reference orders by ingest time only; the
    rest makes the choice deterministic."""
    cols = [
        F.col("ingested_at").desc_nulls_last(),
        F.col("source_batch_id").desc_nulls_last(),
        F.col("value").desc_nulls_last(),
    ]
    return cols + [F.col(c).desc_nulls_last() for c in extra]


def dedupe_keep_latest_window(df: DataFrame, key: str = "reading_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """``row_number() over (partition by key order by …) = 1``."""
    w = Window.partitionBy(key).orderBy(*latest_copy_order(extra))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_keep_latest_agg(df: DataFrame, key: str = "reading_id", extra: tuple[str, ...] = ()) -> DataFrame:
    """Same result as the window form, written as one aggregate: the maximum
    of a struct whose leading fields are the ordering keys."""
    order = ["ingested_at", "source_batch_id", "value", *extra]
    payload = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in order + payload]).select(
        *df.columns
    )


def build_silver(
    bronze: DataFrame,
    as_of: datetime | None = None,
    method: str = "window",
    with_build_stamp: bool = True,
) -> DataFrame:
    typed = typed_readings(bronze)
    dedupe = dedupe_keep_latest_window if method == "window" else dedupe_keep_latest_agg
    kept = dedupe(typed)
    out = kept.select(*[c for c in SILVER_COLUMNS if c != "quality_flag" and c in kept.columns], quality_flag("value").alias("quality_flag"))
    cols = [F.col(c) for c in SILVER_COLUMNS]
    if with_build_stamp:
        stamp = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
        cols.append(stamp.alias("silver_built_at"))
    return out.select(*cols)
