"""Query catalogue: each entry takes ``(spark, sf_dir)`` and returns a
DataFrame computed over the whole ``events`` / ``supplier`` tables (through
the fixed reading mapping in :mod:`gaugeflow.sources.derived`)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.functions.keys import mint_reading_id
from gaugeflow.functions.timefns import to_ntz
from gaugeflow.functions.values import try_double
from gaugeflow.operators import backtest, checks, dashboard, forecast, gold, ingest, lineage, metrics, silver, trace
from gaugeflow.operators.asof import asof_every, asof_lag
from gaugeflow.session import materialize as materialize_table
from gaugeflow.session import scratch_path
from gaugeflow.sinks.tables import save_bucketed
from gaugeflow.sources import derived

# FIXED VALUES: clocks and parameters of the registered queries.
AS_OF_SERIES = datetime(2024, 2, 10, 0, 0, 0)
AS_OF_BRONZE = datetime(2024, 4, 10, 0, 0, 0)
AS_OF_FRESHNESS = datetime(2024, 1, 31, 0, 0, 0)
AS_OF_HEALTH = datetime(2024, 1, 31, 12, 0, 0)
LOOKBACK_SINCE = "2024-01-29T18:00:00Z"
REFLAG_THRESHOLD = 30.0
PRIMARY_STATION = "7"
NEWEST_N = 10
MONTH_FIT_HOURS = 720
DOCUMENT_POINTS = 5


@dataclass
class Layers:
    bronze: DataFrame
    dim: DataFrame
    silver: DataFrame
    series: DataFrame
    latest: DataFrame | None


def layers(spark: SparkSession, sf_dir: str, materialize: bool = True, materialize_latest: bool = False) -> Layers:
    """The layers of one run.

    Silver is written once as Parquet to the shared checkpoint folder and
    read back (``materialize``), as a medallion build does: consumers that
    read it more than once (the as-of reads it twice, lineage and checks
    several times) then scan columnar files with the stage filter pushed
    down instead of recomputing the dedupe from bronze per branch, and the
    lineage is cut there (a lost executor recomputes from those files).
    Queries that read silver once pass ``materialize=False``. The latest
    table is also written when several consumers read it."""
    b = derived.bronze(spark, sf_dir)
    dim = derived.stations(spark, sf_dir)
    s = silver.build_silver(b, with_build_stamp=False)
    if materialize:
        s = materialize_table(s, "silver")
    series = gold.gold_series(s, AS_OF_SERIES)
    latest = gold.gold_latest(s, dim)
    if materialize_latest:
        latest = materialize_table(latest, "gold_latest")
    return Layers(b, dim, s, series, latest)


#: What the latest table reads of silver.
STAGE_READ = (
    "reading_id", "measure", "station_reference", "station_label", "parameter", "qualifier", "unit_name",
    "date_time_utc", "value", "quality_flag",
)


def stage_table(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = STAGE_READ) -> DataFrame:
    """The stage rows of silver, filtered and pruned before they are written:
    the as-of reads them twice, nothing needs the rest of silver."""
    rows = gold.stage_rows(layers(spark, sf_dir, materialize=False).silver)
    return materialize_table(rows.select(*columns), "stage")


def latest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_latest(stage_table(spark, sf_dir), derived.stations(spark, sf_dir))


def series_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold series alone, written once for consumers that read it twice."""
    return materialize_table(layers(spark, sf_dir, materialize=False).series, "series")


def q_mint_reading_id(spark, d):
    b = derived.bronze(spark, d)
    return b.select("measure", "date_time", "reading_id").distinct()


def q_bronze_copies(spark, d):
    return lineage.copy_summary(derived.bronze(spark, d))


def q_silver_readings(spark, d):
    return layers(spark, d, materialize=False).silver


def q_silver_flag_counts(spark, d):
    return layers(spark, d, materialize=False).silver.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n"))


def _dedupe(method):
    def q(spark, d):
        typed = silver.typed_readings(derived.bronze(spark, d))
        fn = silver.dedupe_keep_latest_window if method == "window" else silver.dedupe_keep_latest_agg
        return fn(typed).select("reading_id", "measure", "date_time_utc", "value", "ingested_at", "source_batch_id")

    return q


def q_null_key_rows_dropped(spark, d):
    b = derived.bronze(spark, d)
    kept = F.col("measure").isNotNull() & F.col("date_time").isNotNull()
    return b.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(kept).alias("kept_rows"),
        F.count_if(~kept).alias("dropped_rows"),
    )


def q_try_cast_values(spark, d):
    b = derived.bronze(spark, d)
    return b.select("reading_id", to_ntz("_ingested_at").alias("ingested_at"), try_double("value").alias("value"))


def q_gold_series_30d(spark, d):
    return layers(spark, d, materialize=False).series


def q_gold_station_latest(spark, d):
    return latest_table(spark, d)


def _asof(lag):
    def q(spark, d):
        st = stage_table(spark, d, ("reading_id", "measure", "date_time_utc", "value"))
        r = asof_lag(st, "measure", "date_time_utc", "value", lag=lag, tie="reading_id",
                     cols=["measure", "date_time_utc"], out_col="value_lag")
        return r.select("measure", F.col("date_time_utc").alias("latest_at"), "value_lag")

    return q


def q_threshold_flags(spark, d):
    return latest_table(spark, d).select("station_reference", "measure", "latest_value", "threshold", "above_threshold")


def q_above_threshold_count(spark, d):
    return metrics.headline_counts(latest_table(spark, d))


def q_headline_ordered(spark, d):
    return metrics.headline_ordered(latest_table(spark, d))


def q_bronze_window_90d(spark, d):
    w = ingest.bronze_window(derived.bronze(spark, d), AS_OF_BRONZE, 90)
    return w.select("reading_id", "measure", "date_time", try_double("value").alias("value"), "_ingested_at")


def q_semi_silver_in_gold(spark, d):
    L = layers(spark, d)
    return lineage.semi_in(L.silver, L.series).select("reading_id", "value", "quality_flag", "ingested_at")


def q_semi_bronze_in_gold(spark, d):
    L = layers(spark, d, materialize=False)
    return lineage.bronze_copy_rows(lineage.semi_in(L.bronze, L.series))


def q_lineage_flat(spark, d):
    L = layers(spark, d)
    return lineage.lineage_flat(L.bronze, L.silver, L.series)


def q_lineage_nested(spark, d):
    L = layers(spark, d)
    return lineage.lineage_nested(L.bronze, L.silver, L.series)


def q_trace_one(spark, d):
    """One data-derived key through all layers. The key reaches the scan of bronze
    below each layer (also through silver's window), so no layer is built for it."""
    L = layers(spark, d, materialize=False)
    return trace.trace_by_id(L.bronze, L.silver, L.series, _traced_key(L))


def _by_reach(series: DataFrame) -> DataFrame:
    return series.withColumn("reach", derived.reach("station_reference"))


def q_forecast_points(spark, d):
    return forecast.forecast_points(_by_reach(series_table(spark, d)), group="reach")


def q_forecast_points_by_station(spark, d):
    """Forecast grouped by station, as the dashboard publishes it."""
    return forecast.forecast_points(series_table(spark, d), group="station_reference")


def q_series_with_forecast(spark, d):
    s = _by_reach(series_table(spark, d))
    fc = forecast.forecast_points(s, group="reach")
    return metrics.extent_with_forecast(s, fc, group="reach")


def q_forecast_guard(spark, d):
    m = forecast.forecast_model(series_table(spark, d), group="station_reference")
    return m.select("station_reference", "n_points", "n_recent", "eligible")


def q_series_extent(spark, d):
    return metrics.series_extent(layers(spark, d, materialize=False).series)


def q_slider_bounds(spark, d):
    L = layers(spark, d, materialize_latest=True)
    return metrics.slider_bounds(metrics.series_extent(L.series), metrics.thresholds_by_station(L.latest))


def q_reflag_threshold(spark, d):
    return metrics.reflag(layers(spark, d, materialize=False).series, REFLAG_THRESHOLD)


def q_primary_series(spark, d):
    return metrics.primary_series(series_table(spark, d), PRIMARY_STATION)


def _dq(spark, d, L: Layers | None = None):
    L = L or layers(spark, d, materialize_latest=True)
    tables = {"silver": L.silver, "gold_series": L.series, "gold_station_latest": L.latest, "dim_stations": L.dim}
    return checks.run_checks(tables)


def q_dq_results(spark, d):
    return _dq(spark, d)


def q_dq_summary(spark, d):
    return checks.summarize(_dq(spark, d))


def q_orphan_stations(spark, d):
    L = layers(spark, d, materialize=False)
    return (
        L.silver.where(F.col("station_reference").isNotNull())
        .join(L.dim.select("station_reference"), "station_reference", "left_anti")
        .groupBy("station_reference")
        .agg(F.count(F.lit(1)).alias("silver_rows"))
    )


def q_station_grain_conflicts(spark, d):
    return (
        latest_table(spark, d)
        .groupBy("station_reference")
        .agg(F.count(F.lit(1)).alias("n_measures"))
        .where(F.col("n_measures") > 1)
    )


def q_rows_per_day(spark, d):
    return ingest.rows_per_day(derived.bronze(spark, d))


def q_run_metadata(spark, d):
    L = layers(spark, d, materialize_latest=True)
    summary = checks.summarize(_dq(spark, d, L))
    counts = L.silver.agg(F.count(F.lit(1)).alias("silver_rows"))
    head = metrics.headline_counts(L.latest)
    # The last ingest run: the newest batch stamp and the rows that carry it.
    batches = L.bronze.groupBy(to_ntz("_ingested_at").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    ingest_meta = batches.agg(F.max_by("n", "at").alias("rows_ingested"), F.max("at").alias("last_run_utc"))
    # One-row aggregates combined as scalar subqueries, each referenced once
    # (fields are taken in a second projection, so no subquery is repeated).
    wide = ingest_meta.select(
        "last_run_utc",
        "rows_ingested",
        counts.scalar().alias("silver_rows"),
        head.select(F.struct("*")).scalar().alias("_h"),
        summary.select(F.struct("*")).scalar().alias("_t"),
    )
    return wide.select(
        "last_run_utc",
        "rows_ingested",
        "silver_rows",
        F.col("_h.n_stations").alias("stations"),
        F.col("_h.n_above").alias("above_threshold"),
        F.col("_t.tests_passed").alias("tests_passed"),
        F.col("_t.tests_total").alias("tests_total"),
        F.when(F.col("_t.publishable"), F.lit("ok")).otherwise(F.lit("failed")).alias("status"),
    )


def q_run_health(spark, d):
    """Dashboard health of the run: age of the last run and the stale flag."""
    return metrics.health(q_run_metadata(spark, d), AS_OF_HEALTH)


def q_freshness(spark, d):
    return metrics.freshness(layers(spark, d, materialize=False).silver, "date_time_utc", AS_OF_FRESHNESS, group="station_reference")


def q_newest_n_per_station(spark, d):
    s = layers(spark, d, materialize=False).silver
    return ingest.newest_n(s, NEWEST_N).select("station_reference", "reading_id", "date_time_utc", "rank")


def q_lookback_since(spark, d):
    s = layers(spark, d, materialize=False).silver
    return ingest.lookback_since(s, LOOKBACK_SINCE).select("reading_id", "station_reference", "date_time_utc", "value")


def q_flatten_payload(spark, d):
    from gaugeflow.sources import payloads

    text = payloads.reading_payload_text(derived.load(spark, d, "events"))
    return payloads.flatten_readings(payloads.parse_reading_payloads(text))


DISCOVER_SEARCH = "00000001"


def q_discover_stations(spark, d):
    from gaugeflow.sources import payloads

    text = payloads.station_payload_text(derived.load(spark, d, "supplier"))
    return payloads.discover_stations(payloads.parse_station_payloads(text), search=DISCOVER_SEARCH)


def q_drifted_scan(spark, d):
    from gaugeflow.sources import bronze as bronze_src

    root = scratch_path(spark, "drifted")
    bronze_src.write_drifted(derived.bronze(spark, d), root)
    b = bronze_src.read_bronze(spark, root)
    return b.select("reading_id", to_ntz("_ingested_at").alias("ingested_at"), try_double("value").alias("value"))


def _land_bronze_files(spark, d, root):
    """Bronze landed as several files per reading date (copies of one key
    may sit in different files, hence in different micro-batches)."""
    b = derived.bronze(spark, d).withColumn("dt", ingest.reading_date())
    b.repartition(4).write.partitionBy("dt").parquet(root)


def _stream_silver_folder(spark, d):
    from gaugeflow.streaming import silver_stream

    base = scratch_path(spark, "stream")
    _land_bronze_files(spark, d, f"{base}/bronze")
    q = silver_stream.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/_chk_silver", max_files=48)
    q.awaitTermination()
    return base


def q_stream_silver(spark, d):
    from gaugeflow.streaming import silver_stream

    base = _stream_silver_folder(spark, d)
    return silver_stream.read_silver(spark, f"{base}/silver")


def q_stream_latest(spark, d):
    from gaugeflow.streaming import silver_stream

    base = _stream_silver_folder(spark, d)
    q = silver_stream.start_latest(spark, f"{base}/silver", f"{base}/latest", f"{base}/_chk_latest")
    q.awaitTermination()
    return silver_stream.read_newest(spark, f"{base}/latest")


def q_landed_bronze_days(spark, d):
    """Bronze landed in two runs (reading-date layout), compacted, read back:
    rows per date and batch. Every copy survives landing and compaction."""
    from gaugeflow.sinks.landing import compact_bronze, land_bronze

    base = scratch_path(spark, "landing")
    b = derived.bronze(spark, d).drop("_ingested_at", "_source_batch_id")
    early = F.substring("reading_id", 1, 1) < "8"
    land_bronze(b.where(early), f"{base}/bronze", "2024-02-01T00:00:00Z")
    land_bronze(b.where(~early), f"{base}/bronze", "2024-02-01T03:00:00Z")
    c = compact_bronze(spark, f"{base}/bronze", f"{base}/compacted")
    return c.groupBy("dt", "batch").agg(F.count(F.lit(1)).alias("rows"))


def q_lineage_lookup(spark, d):
    """Lineage written in a key-prefix layout, then every plotted key looked up."""
    from gaugeflow.sinks.landing import write_lookup_table

    L = layers(spark, d, materialize_latest=True)
    path = scratch_path(spark, "lineage")
    write_lookup_table(lineage.lineage_flat(L.bronze, L.silver, L.series), path)
    return spark.read.parquet(path).drop("key_prefix")


INGEST_RUN_TS = datetime(2024, 1, 30, 0, 0, 0)
INGEST_LOOKBACK_HOURS = 48


def q_ingest_run(spark, d):
    """Payload files from ``events`` landed by the batch ingest run for the
    stations of ``supplier`` and a 48 h lookback: the bronze rows it wrote."""
    from gaugeflow.plans.ingest import ingest_run
    from gaugeflow.sources import payloads

    base = scratch_path(spark, "ingest")
    payloads.reading_payload_text(derived.load(spark, d, "events")).write.text(f"{base}/payloads")
    ingest_run(
        spark, f"{base}/payloads", f"{base}/bronze", {"stations": []}, INGEST_RUN_TS,
        hours=INGEST_LOOKBACK_HOURS, stations=derived.stations(spark, d),
    )
    b = spark.read.parquet(f"{base}/bronze")
    return b.select("reading_id", "station_reference", "date_time", try_double("value").alias("value"), "_ingested_at", "batch")


def q_stream_bronze(spark, d):
    """Payload files from ``events`` landed by the stream: the bronze rows."""
    from gaugeflow.sources import payloads
    from gaugeflow.streaming.bronze_stream import start_ingest

    base = scratch_path(spark, "stream-bronze")
    payloads.reading_payload_text(derived.load(spark, d, "events")).write.text(f"{base}/payloads")
    start_ingest(spark, f"{base}/payloads", f"{base}/bronze", f"{base}/_chk", max_files=48).awaitTermination()
    b = spark.read.parquet(f"{base}/bronze").withColumn("value", try_double("value"))
    return b.select(*payloads.BRONZE_FIELDS)


def q_landed_run_date(spark, d):
    """Bronze landed by run date (one folder per run), read back."""
    from gaugeflow.sinks.landing import land_bronze

    root = scratch_path(spark, "landing-run")
    b = derived.bronze(spark, d).drop("_ingested_at", "_source_batch_id")
    land_bronze(b, root, "2024-02-01T00:00:00Z", by="run")
    return spark.read.parquet(root).groupBy("dt", "batch").agg(F.count(F.lit(1)).alias("rows"))


def q_stream_gold_latest(spark, d):
    """Gold latest table (with the 24 h as-of) kept current by the silver
    stream, over bronze files landed from ``events``."""
    from gaugeflow.streaming import silver_stream

    base = scratch_path(spark, "stream-gold")
    _land_bronze_files(spark, d, f"{base}/bronze")
    q = silver_stream.start_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/_chk", max_files=48,
        latest_root=f"{base}/latest", dim=derived.stations(spark, d),
    )
    q.awaitTermination()
    return silver_stream.read_latest(spark, f"{base}/latest")


def q_payload_files(spark, d):
    """Station payload documents written over several lines each, many to a file, and
    cut out of its splits again: every station of ``supplier``."""
    from gaugeflow.sources import payloads

    base = scratch_path(spark, "payload-files")
    one_line = payloads.station_payload_text(derived.load(spark, d, "supplier"))
    # A break before every member and item: no line of a file is a document by itself.
    indented = one_line.withColumn("json", F.regexp_replace("json", r'([{,\[])(["{])', "$1\n  $2"))
    indented.select("json").write.text(base)
    return payloads.discover_stations(payloads.read_station_payloads(spark, base))


def q_dim_csv(spark, d):
    """The station dimension written as CSV and read with its declared schema."""
    from gaugeflow.sources import dims

    path = scratch_path(spark, "dim-csv")
    derived.stations(spark, d).write.option("header", "true").csv(path)
    return dims.read_dim_csv(spark, path)


def q_ingest_empty(spark, d):
    """A batch run for a station that no payload names: both documents are
    written, with zero rows."""
    from gaugeflow.plans.ingest import ingest_run
    from gaugeflow.sources import payloads
    from gaugeflow.sources.meta import INGEST_META, read_json_or_nulls

    base = scratch_path(spark, "ingest-empty")
    payloads.reading_payload_text(derived.load(spark, d, "events")).write.text(f"{base}/payloads")
    config = {"stations": [{"station_reference": "no such station"}]}
    ingest_run(
        spark, f"{base}/payloads", f"{base}/bronze", config, INGEST_RUN_TS,
        hours=INGEST_LOOKBACK_HOURS, meta_path=f"{base}/meta.json",
    )
    return read_json_or_nulls(spark, f"{base}/meta.json", INGEST_META).drop("attribution")


def q_lineage_records(spark, d):
    L = layers(spark, d, materialize=False)
    return lineage.lineage_records(L.bronze, L.series)


def q_lineage_documents(spark, d):
    """The lineage documents encoded as JSON, decoded again field by field."""
    L = layers(spark, d)
    docs = lineage.lineage_json(lineage.lineage_nested(L.bronze, L.silver, L.series))
    at = lambda path, kind="string": F.get_json_object("json", path).cast(kind)
    return docs.select(
        at("$.reading_id").alias("reading_id"),
        at("$.station_reference").alias("station_reference"),
        at("$.date_time_utc").alias("date_time_utc"),
        at("$.bronze.copies", "long").alias("copies"),
        at("$.bronze.first_ingested_at").alias("first_ingested_at"),
        at("$.bronze.last_ingested_at").alias("last_ingested_at"),
        at("$.silver.value", "double").alias("silver_value"),
        at("$.silver.quality_flag").alias("quality_flag"),
        at("$.silver.ingested_at").alias("kept_ingested_at"),
        at("$.gold.value", "double").alias("gold_value"),
        at("$.gold.unit_name").alias("unit_name"),
    )


def _traced_key(L: Layers) -> str:
    """The most copied plotted key as pasted text, with stray marks around it
    (one value; empty when nothing is plotted)."""
    row = trace.most_copied_in_one_pass(L.bronze, AS_OF_SERIES).first()
    return f" {{{row['reading_id']}}} " if row else ""


def q_trace_by_id(spark, d):
    L = layers(spark, d)
    return trace.trace_by_id(L.bronze, L.silver, L.series, _traced_key(L))


def q_trace_records(spark, d):
    """The bronze copies of one literal key."""
    L = layers(spark, d, materialize=False)
    return trace.trace_records(L.bronze, _traced_key(L))


def with_positions(ordered: DataFrame, name: str) -> DataFrame:
    """An ordered table written and read back with every row's position: ordinal over the
    files in name order. A running sum over file counts gives the offsets, so no
    task sorts or numbers all rows."""
    spark, path = ordered.sparkSession, scratch_path(ordered.sparkSession, name)
    ordered.write.parquet(path)
    stored = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    sizes = stored.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("file", before.alias("offset"))
    position = (F.col("offset") + F.col("row") + 1).cast("long").alias("position")
    return stored.join(offsets, "file").select(*ordered.columns, position)


def q_series_stored_order(spark, d):
    """The gold series written in its physical order, read back with every row's position."""
    ordered = gold.sort_series_for_write(layers(spark, d, materialize=False).series)
    return with_positions(ordered, "series-order").select("reading_id", "station_reference", "date_time_utc", "position")


def q_series_by_time(spark, d):
    """The series as a chart reads it, by time over all stations."""
    ordered = gold.ordered_series(layers(spark, d, materialize=False).series)
    return with_positions(ordered, "series-time").select("reading_id", "date_time_utc", "position")


def q_lineage_record_order(spark, d):
    """The bronze copies of all plotted keys as they are stored, oldest ingest first per key."""
    L = layers(spark, d, materialize=False)
    ordered = lineage.sort_records_for_write(lineage.lineage_records(L.bronze, L.series))
    return with_positions(ordered, "record-order").select("reading_id", "ingested_at", "position")


def q_trace_record_order(spark, d):
    """The bronze copies of one literal key in the order in which a trace shows them."""
    L = layers(spark, d, materialize=False)
    return with_positions(trace.trace_records(L.bronze, _traced_key(L)), "trace-order")


def q_headline_rank(spark, d):
    """Rows of the headline in their order, one per station."""
    latest = gold.gold_latest(stage_of(_one_measure_per_station(derived.bronze(spark, d))), derived.stations(spark, d))
    return with_positions(metrics.headline_ordered(latest), "headline").select("station_reference", "above_threshold", "position")


def stage_of(bronze: DataFrame) -> DataFrame:
    return materialize_table(gold.stage_rows(silver.build_silver(bronze, with_build_stamp=False)), "stage")


def q_forecast_station_month(spark, d):
    """Forecast per station with a fit over the whole 30-day window."""
    return forecast.forecast_points(series_table(spark, d), group="station_reference", fit_hours=MONTH_FIT_HOURS)


def q_dq_offending_values(spark, d):
    """The checks over silver with a parameter outside the accepted values."""
    L = layers(spark, d, materialize_latest=True)
    renamed = F.when(F.col("parameter") == "flow", "discharge").otherwise(F.col("parameter"))
    return _dq(spark, d, Layers(L.bronze, L.dim, L.silver.withColumn("parameter", renamed), L.series, L.latest))


def _one_measure_per_station(bronze: DataFrame) -> DataFrame:
    """Bronze in which the checks pass: a station has one measure."""
    b = bronze.withColumn("measure", F.concat(F.lit("user-"), "station_reference"))
    return b.withColumn("reading_id", mint_reading_id("measure", "date_time"))


def _published(spark, d, *bronzes: DataFrame) -> DataFrame:
    from gaugeflow.plans import pipeline, publish

    root = scratch_path(spark, "published")
    for b in bronzes:
        pipeline.run_pipeline(spark, d, root, as_of=AS_OF_SERIES, bronze_as_of=AS_OF_BRONZE, bronze=b)
    return publish.read_published(spark, root, "gold_station_latest")


def q_published_latest(spark, d):
    """The latest table that readers of the pointer see after a good run."""
    return _published(spark, d, _one_measure_per_station(derived.bronze(spark, d)))


def q_published_after_failed_run(spark, d):
    """A good run, then one whose checks fail: readers still see the good one."""
    b = derived.bronze(spark, d)
    return _published(spark, d, _one_measure_per_station(b), b)


def q_asof_every_reading(spark, d):
    """The change over 24 h at every stage reading, not only the newest."""
    st = stage_table(spark, d, ("reading_id", "measure", "date_time_utc", "value"))
    r = asof_every(st, "measure", "date_time_utc", "value", lag="24 hours", tie="reading_id", out_col="value_24h_ago")
    return r.withColumn("change_24h", F.round(F.col("value") - F.col("value_24h_ago"), 3))


def _published_root(spark, d):
    from gaugeflow.plans import pipeline

    root = scratch_path(spark, "published")
    pipeline.run_pipeline(spark, d, root, as_of=AS_OF_SERIES, bronze_as_of=AS_OF_BRONZE, bronze=_one_measure_per_station(derived.bronze(spark, d)))
    return root


def q_run_document(spark, d):
    """The run document that a published run leaves, read back with its stages."""
    from gaugeflow.plans import publish

    doc = publish.read_published(spark, _published_root(spark, d), "run_meta", fmt="json")
    stages = F.array_join(F.transform("stages", lambda s: F.concat(s["name"], F.lit(":"), s["status"])), ",")
    return doc.select("silver_rows", "stations", "above_threshold", "tests_passed", "tests_total", stages.alias("stages"), "status", "attribution")


def q_layer_views(spark, d):
    """Rows of every published layer, counted through the SQL views over it."""
    from gaugeflow.sources import views

    views.register_published(spark, _published_root(spark, d))
    parts = [spark.sql(f"SELECT '{v}' AS view, count(*) AS rows, count(DISTINCT reading_id) AS keys FROM {v}") for v in views.LAYER_VIEWS]
    return reduce(DataFrame.unionByName, parts)


def q_heartbeat(spark, d):
    """The heartbeat of a batch run and the health read from it."""
    from gaugeflow.plans.ingest import ingest_run
    from gaugeflow.sources import payloads

    base = scratch_path(spark, "heartbeat")
    payloads.reading_payload_text(derived.load(spark, d, "events")).write.text(f"{base}/payloads")
    ingest_run(spark, f"{base}/payloads", f"{base}/bronze", {"stations": []}, INGEST_RUN_TS, hours=INGEST_LOOKBACK_HOURS, stations=derived.stations(spark, d))
    return metrics.heartbeat_health(spark, f"{base}/bronze/_latest.json", AS_OF_FRESHNESS).select("last_run_utc", "rows", "age_minutes", "stale", "health_status")


def q_test_stats(spark, d):
    """Passed and all tests of a run-results document in which other entries stand between them."""
    from gaugeflow.sources.meta import read_test_results

    path = scratch_path(spark, "run-results")
    entry = lambda name, status: F.struct(name.alias("unique_id"), status.alias("status"))
    models = _dq(spark, d).select(F.explode(F.array(entry(F.col("test_id"), F.col("status")), entry(F.concat(F.lit("model."), "model"), F.lit("pass")))).alias("r"))
    # One document, of as many entries as there are checks.
    models.agg(F.collect_list("r").alias("results")).write.json(path)
    return checks.test_stats(read_test_results(spark, path))


#: A run whose clock is behind: all its readings are stamped after it.
LATE_CLOCK = datetime(2024, 1, 1, 0, 0, 0)


def _run_date_bronze(spark, d):
    """Bronze as files landed by run date, with the stamps of the copies."""
    from gaugeflow.streaming.bronze_stream import write_bronze_batch

    root = scratch_path(spark, "run-date")
    b = derived.bronze(spark, d).withColumn("dt", F.lit(LATE_CLOCK).cast("date")).withColumn("batch", F.lit("late-clock"))
    write_bronze_batch(b, root)
    return spark.read.parquet(root)


def q_lineage_run_date(spark, d):
    """Lineage over bronze landed by run date, readings stamped after their run."""
    b = _run_date_bronze(spark, d)
    s = materialize_table(silver.build_silver(b, with_build_stamp=False), "silver")
    return lineage.lineage_flat(b, s, gold.gold_series(s, AS_OF_SERIES), by="run")


def q_bronze_window_run_date(spark, d):
    """The 90-day export of bronze landed by run date."""
    w = ingest.bronze_window(_run_date_bronze(spark, d), AS_OF_BRONZE, 90, by="run")
    return w.select("reading_id", "measure", "date_time", try_double("value").alias("value"), "_ingested_at")


def q_forecast_backtest(spark, d):
    """The trend at every instant of the series, and the forecast made six hours before it."""
    r = backtest.backtest(_by_reach(series_table(spark, d)), group="reach")
    return r.withColumn("slope", F.round("slope", 9))


def q_dashboard_documents(spark, d):
    """The station documents written as JSON lines in small chunks, decoded field by field."""
    s = series_table(spark, d)
    docs = dashboard.station_documents(s, forecast.forecast_points(s, fit_hours=MONTH_FIT_HOURS), chunk_points=DOCUMENT_POINTS)
    path = scratch_path(spark, "dashboard")
    docs.write.option("ignoreNullFields", "false").json(path)
    read = spark.read.schema(docs.schema).json(path)
    head = ["station_reference", "chunk", "chunks", "forecast_method"]
    seen = read.select(*head, "first_position", F.posexplode("series").alias("at", "p")).select(
        *head, F.lit("observed").alias("kind"), (F.col("first_position") + F.col("at")).alias("position"), "p.date_time_utc", "p.value", "p.reading_id"
    )
    ahead = read.select(*head, F.posexplode("forecast").alias("at", "p")).select(
        *head, "p.kind", F.col("at").cast("long").alias("position"), "p.date_time_utc", "p.value", F.lit(None).cast("string").alias("reading_id")
    )
    return seen.unionByName(ahead)


def q_trace_sql(spark, d):
    """The table function over the catalog's views, called in SQL with a bound parameter."""
    from gaugeflow.sources import views

    b = _one_measure_per_station(derived.bronze(spark, d))
    row = trace.most_copied_in_one_pass(b, AS_OF_SERIES).first()
    views.register_catalog(spark, _published_root(spark, d), prefix="gaugeflow_")
    return spark.sql("SELECT * FROM gaugeflow_trace(:rid)", args={"rid": f" {{{row['reading_id']}}} " if row else ""})


def bucketed_layers(spark: SparkSession, sf_dir: str, prefix: str = "gaugeflow_bucketed_", buckets: int | None = None) -> Layers:
    """Bronze, silver and series as catalog tables that share one bucketing on the key."""
    base = scratch_path(spark, "bucketed")

    def saved(df: DataFrame, name: str) -> DataFrame:
        return save_bucketed(df, f"{prefix}{name}", f"{base}/{name}", buckets=buckets)

    b = saved(derived.bronze(spark, sf_dir), "bronze")
    s = saved(silver.build_silver(b, with_build_stamp=False), "silver")
    series = saved(gold.gold_series(s, AS_OF_SERIES), "series")
    return Layers(b, derived.stations(spark, sf_dir), s, series, None)


def q_lineage_bucketed(spark, d):
    """Lineage over bucketed tables, silver built from bucketed bronze: no exchange on the key."""
    L = bucketed_layers(spark, d)
    return lineage.lineage_flat(L.bronze, L.silver, L.series)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "mint_reading_id": q_mint_reading_id,
    "bronze_copies": q_bronze_copies,
    "silver_readings": q_silver_readings,
    "silver_flag_counts": q_silver_flag_counts,
    "dedupe_keep_latest_window": _dedupe("window"),
    "dedupe_keep_latest_agg": _dedupe("agg"),
    "null_key_rows_dropped": q_null_key_rows_dropped,
    "try_cast_values": q_try_cast_values,
    "gold_series_30d": q_gold_series_30d,
    "gold_station_latest": q_gold_station_latest,
    "asof_24h": _asof("24 hours"),
    "asof_6h": _asof("6 hours"),
    "threshold_flags": q_threshold_flags,
    "above_threshold_count": q_above_threshold_count,
    "headline_ordered": q_headline_ordered,
    "bronze_window_90d": q_bronze_window_90d,
    "semi_silver_in_gold": q_semi_silver_in_gold,
    "semi_bronze_in_gold": q_semi_bronze_in_gold,
    "lineage_flat": q_lineage_flat,
    "lineage_nested": q_lineage_nested,
    "trace_one": q_trace_one,
    "forecast_points": q_forecast_points,
    "forecast_points_by_station": q_forecast_points_by_station,
    "series_with_forecast": q_series_with_forecast,
    "forecast_guard": q_forecast_guard,
    "series_extent": q_series_extent,
    "slider_bounds": q_slider_bounds,
    "reflag_threshold": q_reflag_threshold,
    "primary_series": q_primary_series,
    "dq_results": q_dq_results,
    "dq_summary": q_dq_summary,
    "orphan_stations": q_orphan_stations,
    "station_grain_conflicts": q_station_grain_conflicts,
    "rows_per_day": q_rows_per_day,
    "run_metadata": q_run_metadata,
    "freshness": q_freshness,
    "run_health": q_run_health,
    "newest_n_per_station": q_newest_n_per_station,
    "lookback_since": q_lookback_since,
    "flatten_payload": q_flatten_payload,
    "discover_stations": q_discover_stations,
    "drifted_scan": q_drifted_scan,
    "stream_silver": q_stream_silver,
    "stream_latest": q_stream_latest,
    "landed_bronze_days": q_landed_bronze_days,
    "lineage_lookup": q_lineage_lookup,
    "ingest_run": q_ingest_run,
    "stream_gold_latest": q_stream_gold_latest,
    "stream_bronze": q_stream_bronze,
    "landed_run_date": q_landed_run_date,
    "payload_files": q_payload_files,
    "dim_csv": q_dim_csv,
    "ingest_empty": q_ingest_empty,
    "lineage_records": q_lineage_records,
    "lineage_documents": q_lineage_documents,
    "trace_by_id": q_trace_by_id,
    "trace_records": q_trace_records,
    "series_stored_order": q_series_stored_order,
    "forecast_station_month": q_forecast_station_month,
    "dq_offending_values": q_dq_offending_values,
    "published_latest": q_published_latest,
    "published_after_failed_run": q_published_after_failed_run,
    "asof_every_reading": q_asof_every_reading,
    "series_by_time": q_series_by_time,
    "lineage_record_order": q_lineage_record_order,
    "trace_record_order": q_trace_record_order,
    "headline_rank": q_headline_rank,
    "run_document": q_run_document,
    "layer_views": q_layer_views,
    "heartbeat": q_heartbeat,
    "test_stats": q_test_stats,
    "lineage_run_date": q_lineage_run_date,
    "bronze_window_run_date": q_bronze_window_run_date,
    "forecast_backtest": q_forecast_backtest,
    "dashboard_documents": q_dashboard_documents,
    "trace_sql": q_trace_sql,
    "lineage_bucketed": q_lineage_bucketed,
}
