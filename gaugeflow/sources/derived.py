"""Readings and stations derived from the driver's tables.

The test data has no gauge readings, so bronze is derived from ``events`` and
the station dimension from ``supplier`` by a fixed rule that the SQL oracle
repeats. One scan of ``events`` produces every copy: the copies of a reading
are generated with ``explode`` (no union of several scans, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.keys import mint_reading_id
from gaugeflow.functions.timefns import iso_z

# FIXED VALUES of the mapping (shared with the SQL oracle).
MEASURE_SPLIT_MOD = 15  # these users get one measure per day
DOWNSTREAM_MOD = 10  # qualifier 'Downstream Stage'
NULL_DATE_MOD = 101  # date_time null
NULL_VALUE_MOD = 97  # value null
TEXT_VALUE_MOD = 89  # value 'n/a'
SECOND_COPY_MOD = 7  # re-ingested 4 h later with value + 0.01
THIRD_COPY_MOD = 21  # re-ingested 7 h later with the first value
COPY_DELAY_HOURS = (1, 4, 7)
SECOND_COPY_BUMP = 0.01
PARAMETER_BY_EVENT = (("error", "flow"), ("signup", "rainfall"))  # else 'level'
REACH_MOD = 4  # forecast group ("reach") = user_id % 4
# Dimension rule.
THRESHOLD_MOD = 3  # threshold_m = 25.0 when s_suppkey % 3 = 0
THRESHOLD_M = 25.0
NO_RANGE_MOD = 5  # typical_range_high = 40.0 unless s_suppkey % 5 = 0
TYPICAL_RANGE_HIGH = 40.0


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _measure(user_id: Column, ts: Column) -> Column:
    day = F.when(user_id % MEASURE_SPLIT_MOD == 0, F.concat(F.lit("-"), F.date_format(ts, "yyyy-MM-dd"))).otherwise(
        F.lit("")
    )
    return F.concat(F.lit("user-"), user_id.cast("string"), day)


def _parameter(event_type: Column) -> Column:
    expr = None
    for ev, param in PARAMETER_BY_EVENT:
        expr = (F.when(event_type == ev, F.lit(param)) if expr is None else expr.when(event_type == ev, F.lit(param)))
    return expr.otherwise(F.lit("level"))


def readings_from_events(events: DataFrame) -> DataFrame:
    """Bronze rows (text ``value``, text ingest stamps) from ``events``."""
    eid, ts, uid = F.col("event_id"), F.col("ts"), F.col("user_id")
    first_value = (
        F.when(eid % NULL_VALUE_MOD == 0, F.lit(None).cast("string"))
        .when(eid % TEXT_VALUE_MOD == 0, F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
    )
    # Copy numbers of each event (a third copy implies a second: 21 = 3 * 7).
    copy_ids = (
        F.when(eid % THIRD_COPY_MOD == 0, F.array(F.lit(1), F.lit(2), F.lit(3)))
        .when(eid % SECOND_COPY_MOD == 0, F.array(F.lit(1), F.lit(2)))
        .otherwise(F.array(F.lit(1)))
    )
    base = events.select(
        eid,
        ts,
        uid,
        _measure(uid, ts).alias("measure"),
        F.when(eid % NULL_DATE_MOD == 0, F.lit(None).cast("string")).otherwise(iso_z(ts)).alias("date_time"),
        _parameter(F.col("event_type")).alias("parameter"),
        F.when(eid % DOWNSTREAM_MOD == 0, F.lit("Downstream Stage")).otherwise(F.lit("Stage")).alias("qualifier"),
        first_value.alias("first_value"),
        "value",
        F.explode(copy_ids).alias("copy"),
    )
    k = F.col("copy")
    delay = F.when(k == 1, COPY_DELAY_HOURS[0]).when(k == 2, COPY_DELAY_HOURS[1]).otherwise(COPY_DELAY_HOURS[2])
    ingested = iso_z(F.timestamp_add("HOUR", delay, ts))
    return base.select(
        mint_reading_id("measure", "date_time").alias("reading_id"),
        "measure",
        uid.cast("string").alias("station_reference"),
        F.concat(F.lit("Station "), uid.cast("string")).alias("station_label"),
        "parameter",
        "qualifier",
        F.lit("m").alias("unit_name"),
        "date_time",
        F.when(k == 2, (F.col("value") + F.lit(SECOND_COPY_BUMP)).cast("string"))
        .otherwise(F.col("first_value"))
        .alias("value"),
        ingested.alias("_ingested_at"),
        ingested.alias("_source_batch_id"),
    )


def stations_from_supplier(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    return supplier.select(
        key.cast("string").alias("station_reference"),
        F.col("s_name").alias("station_label"),
        F.concat(F.lit("Nation "), F.col("s_nationkey").cast("string")).alias("river_name"),
        F.when(key % THRESHOLD_MOD == 0, F.lit(THRESHOLD_M)).cast("double").alias("threshold_m"),
        F.when(key % NO_RANGE_MOD != 0, F.lit(TYPICAL_RANGE_HIGH)).cast("double").alias("typical_range_high"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(load(spark, sf_dir, "events"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_from_supplier(load(spark, sf_dir, "supplier"))


def reach(station_reference: Column | str) -> Column:
    """Forecast group of a derived station: user_id % 4."""
    c = F.col(station_reference) if isinstance(station_reference, str) else station_reference
    return (c.cast("long") % REACH_MOD).cast("string")
