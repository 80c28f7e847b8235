"""Silver kept current from a bronze stream, and the latest table behind it.

Silver is a table of runs per reading date (:mod:`gaugeflow.streaming.runs`). A
micro-batch appends its own copies, each key's newest, and readers keep the
newest-ingested copy of a key: the result is that of a batch build
regardless of arrival order, lateness or replays, and a late reading costs one
row, not its date. (``dropDuplicatesWithinWatermark`` would keep the *first* copy: wrong here.)

The latest table is answered from a summary, the last valid reading of each
(measure, day), which is a table of runs as well, in hash buckets of the
measure. A micro-batch recomputes the days it touches from silver's runs of those dates;
the newest day gives the latest value, and the value a lag earlier is the newest
of the earlier days' last values and the rows of the one day that the bound falls into. A
value that silver withdraws leaves the summary and so the table.
"""

from __future__ import annotations

import hashlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.config import ASOF_LAG
from gaugeflow.functions.values import quality_flag
from gaugeflow.operators.gold import LATEST_COLUMNS, stage_rows, threshold_of
from gaugeflow.operators.silver import SILVER_COLUMNS, typed_readings
from gaugeflow.schemas import BRONZE, GOLD_LATEST, SILVER
from gaugeflow.session import materialize
from gaugeflow.streaming.runs import LOG, RunTable

SILVER_STORED = SILVER_COLUMNS + ("reading_date",)
BUCKETS = 64

S, TS = T.StringType(), T.TimestampNTZType()
DAY_ROW = ("reading_id", "station_reference", "station_label", "unit_name", "date_time_utc", "value")
#: The last valid reading of a measure's day; without one the row says so (``reading_id`` null).
DAYS = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("measure", S), T.StructField("reading_date", T.DateType()), T.StructField("version", T.LongType())]
    + [T.StructField(c, SILVER[c].dataType) for c in DAY_ROW]
)
LATEST = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType()), T.StructField("gone", T.BooleanType()), *GOLD_LATEST.fields]
)


def _stored_schema() -> T.StructType:
    fields = [f for f in SILVER.fields if f.name != "silver_built_at"]
    return T.StructType(fields + [T.StructField("reading_date", T.DateType())])


def silver_table(spark: SparkSession, root: str) -> RunTable:
    return RunTable(spark, root, "reading_date", ("reading_id",), ("ingested_at", "source_batch_id", "value"), _stored_schema())


def days_table(spark: SparkSession, latest_root: str) -> RunTable:
    return RunTable(spark, f"{latest_root}/days", "bucket", ("measure", "reading_date"), ("version",), DAYS)


def latest_table(spark: SparkSession, latest_root: str) -> RunTable:
    return RunTable(spark, f"{latest_root}/latest", "bucket", ("measure",), ("version",), LATEST)


def merge_silver_batch(spark: SparkSession, batch: DataFrame, silver_root: str, run: str | None = None) -> DataFrame | None:
    """Appends a micro-batch as one run; returns the (measure, reading_date)
    pairs it touches, None when it has no reading."""
    typed = typed_readings(batch.select(*BRONZE.fieldNames())).withColumn("reading_date", F.to_date("date_time_utc"))
    typed = materialize(typed, "micro-batch")  # read by the run and the touched pairs
    flagged = typed.withColumn("quality_flag", quality_flag("value"))
    if not silver_table(spark, silver_root).append(flagged, run):
        return None
    return typed.select("measure", "reading_date").distinct()


def read_silver(spark: SparkSession, silver_root: str, dates: list | None = None) -> DataFrame:
    return silver_table(spark, silver_root).read(dates).select(*SILVER_COLUMNS)


def _bucket() -> F.Column:
    return F.pmod(F.xxhash64("measure"), F.lit(BUCKETS)).cast("int").alias("bucket")


def refresh_days(spark: SparkSession, silver_root: str, latest_root: str, touched: DataFrame) -> list[int]:
    """Recomputes the summary of the touched (measure, day) pairs from silver's
    runs of those dates alone; returns the touched buckets."""
    # Bounded by the calendar span of the micro-batch, not by its rows.
    dates = [r[0] for r in touched.select("reading_date").distinct().collect()]
    rows = silver_table(spark, silver_root).read(dates).join(touched, ["measure", "reading_date"], "left_semi")
    last = F.max(F.struct("date_time_utc", *[c for c in DAY_ROW if c != "date_time_utc"])).alias("_l")
    newest = stage_rows(rows).groupBy("measure", "reading_date").agg(last)
    days = touched.join(newest, ["measure", "reading_date"], "left").select(
        _bucket(), "measure", "reading_date", F.lit(time.time_ns()).alias("version"), *[F.col(f"_l.{c}").alias(c) for c in DAY_ROW]
    )
    return [int(b) for b in days_table(spark, latest_root).append(days)]


def refresh_latest_batch(
    spark: SparkSession, silver_root: str, latest_root: str, touched: DataFrame, dim: DataFrame | None = None, lag: str = ASOF_LAG
) -> None:
    """Brings the latest rows of the measures of ``touched`` (measure,
    reading_date) up to date: latest value, as-of value, change, threshold. Reads the touched
    dates of silver, the touched buckets of the summary and the days that the
    as-of bounds fall into; writes a run of the touched measures' rows."""
    touched = materialize(touched.where("measure IS NOT NULL AND reading_date IS NOT NULL").distinct(), "touched")
    buckets = refresh_days(spark, silver_root, latest_root, touched)
    if not buckets:
        return
    measures = touched.select("measure").distinct()
    days = days_table(spark, latest_root).read(buckets).where("reading_id IS NOT NULL").join(measures, "measure", "left_semi")
    days = materialize(days, "touched-days")
    newest = days.groupBy("measure").agg(F.max(F.struct("date_time_utc", *[c for c in DAY_ROW if c != "date_time_utc"])).alias("_n"))
    bound = F.col("_n.date_time_utc") - F.expr(f"INTERVAL {lag}")
    newest = materialize(newest.select("measure", "_n", bound.alias("_bound"), F.to_date(bound).alias("_day")), "newest")
    # Earlier days by their last values; the bound's own day row by row.
    earlier = days.join(newest.select("measure", "_bound"), "measure").where("date_time_utc <= _bound").select("measure", "date_time_utc", "reading_id", "value")
    bound_days = [r[0] for r in newest.select("_day").distinct().collect()]  # dates, not rows
    own = stage_rows(silver_table(spark, silver_root).read(bound_days))
    own = own.join(newest.select("measure", "_bound", F.col("_day").alias("reading_date")), ["measure", "reading_date"]).where("date_time_utc <= _bound")
    before = earlier.unionByName(own.select("measure", "date_time_utc", "reading_id", "value"))
    before = before.groupBy("measure").agg(F.max(F.struct("date_time_utc", "reading_id", "value")).alias("_b"))
    found = measures.join(newest, "measure", "left").join(before, "measure", "left")
    stations = dim.select("station_reference", threshold_of().alias("threshold")) if dim is not None else None
    rows = found.select("measure", F.col("_n").isNull().alias("gone"), "_n.*", F.col("_b.value").alias("value_24h_ago"))
    rows = rows.join(stations, "station_reference", "left") if stations is not None else rows.withColumn("threshold", F.lit(None).cast("double"))
    rows = rows.withColumn("latest_at", F.col("date_time_utc")).withColumn("latest_value", F.col("value"))
    rows = rows.withColumn("change_24h", F.round(F.col("value") - F.col("value_24h_ago"), 3)).withColumn("above_threshold", F.col("value") > F.col("threshold"))
    latest_table(spark, latest_root).append(rows.select(_bucket(), F.lit(time.time_ns()).alias("version"), "gone", *LATEST_COLUMNS))


def read_latest(spark: SparkSession, latest_root: str) -> DataFrame:
    """The gold latest table kept by the stream."""
    return latest_table(spark, latest_root).read().where("NOT gone").select(*LATEST_COLUMNS)


def run_name(checkpoint: str, epoch: int) -> str:
    """The run of a micro-batch: the same when the batch is replayed."""
    return f"b-{hashlib.md5(checkpoint.encode()).hexdigest()[:10]}-{epoch:09d}"


def start_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    checkpoint: str,
    max_files: int | None = None,
    latest_root: str | None = None,
    dim: DataFrame | None = None,
):
    """Stream bronze Parquet files into silver; with ``latest_root`` and
    ``dim`` the gold latest table is kept current as well. Returns the
    ``StreamingQuery``."""

    def on_batch(df: DataFrame, epoch: int) -> None:
        touched = merge_silver_batch(spark, df, silver_root, run_name(checkpoint, epoch))
        if touched is not None and latest_root is not None and dim is not None:
            refresh_latest_batch(spark, silver_root, latest_root, touched, dim)

    r = spark.readStream.schema(BRONZE)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    src = r.option("recursiveFileLookup", "true").parquet(bronze_root)
    return (
        src.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
        .trigger(availableNow=True)
        .start()
    )


def start_latest(spark: SparkSession, silver_root: str, out_root: str, checkpoint: str):
    """Latest stage reading per measure, kept current from silver's log: its new
    entries name the runs that a micro-batch appended, whose rows name the measures
    and days to refresh (runs of a compaction change nothing). Read it with :func:`read_newest`."""

    def on_batch(entries: DataFrame, _epoch: int) -> None:
        appended = materialize(entries.where("live AND run LIKE 'b-%'").select("part", "run").distinct(), "appended-runs")
        rows = silver_table(spark, silver_root).rows_of(appended)
        refresh_latest_batch(spark, silver_root, out_root, rows.select("measure", "reading_date"))

    src = spark.readStream.schema(LOG).json(f"{silver_root}/_log")
    return src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch).trigger(availableNow=True).start()


def read_newest(spark: SparkSession, latest_root: str) -> DataFrame:
    """The newest stage reading of each measure."""
    return read_latest(spark, latest_root).select("measure", "reading_id", "station_reference", "latest_at", "latest_value")
