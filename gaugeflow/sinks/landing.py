"""Bronze landing and maintenance.

Every bronze writer uses one layout, ``<root>/dt=<date>/batch=<stamp>/``, and
dynamic partition overwrite of only the partitions a batch produces. Earlier
batches are never touched (append-only history) and rewriting the same batch
is idempotent. ``value`` is always landed as text (the declared bronze
schema), so streaming readers with a fixed schema read every file; the text
of a double converts back to the same double.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeflow.config import ATTRIBUTION
from gaugeflow.operators.ingest import stamp_batch, with_partition_columns
from gaugeflow.plans.publish import qualified, write_text
from gaugeflow.sources.documents import read_documents
from gaugeflow.streaming.bronze_stream import write_bronze_batch


def land_bronze(df: DataFrame, root: str, run_ts_text: str, by: str = "reading") -> int:
    """Stamp a batch and append it under ``dt`` (reading date, or run date
    with ``by='run'``) and ``batch``; returns the rows written, counted by the
    write itself. Rows without a reading time land in the
    default (null) date partition instead of being lost."""
    typed = df.withColumn("value", F.col("value").cast("string"))
    stamped = with_partition_columns(stamp_batch(typed, run_ts_text), run_ts_text, by=by)
    written = Observation()
    write_bronze_batch(stamped, root, written)
    return int(written.get.get("rows") or 0)


def write_heartbeat(spark: SparkSession, root: str, run_ts_text: str, rows: int, blob: str) -> None:
    """``<root>/_latest.json``: name starts with ``_`` so data scans skip it."""
    write_text(
        spark, f"{root.rstrip('/')}/_latest.json", json.dumps({"last_ingest_utc": run_ts_text, "rows": rows, "blob": blob})
    )


def write_ingest_meta(spark: SparkSession, path: str, run_ts_text: str, since: str, rows: int, stations: int) -> None:
    """Run metadata of an ingest, written even when no rows arrived."""
    doc = {
        "last_ingest_utc": run_ts_text,
        "since": since,
        "rows_ingested": rows,
        "stations": stations,
        "attribution": ATTRIBUTION,
    }
    write_text(spark, path, json.dumps(doc))


def copy_raw_feed(spark: SparkSession, src: str, dest: str, bronze_root: str | None = None) -> None:
    """Copy a raw JSON feed to Parquet as evidence: one row per document, its
    text untouched, no key minted. ``dest`` belongs to one copy and is replaced by
    a retry; a place inside bronze is refused (nothing minted lies there)."""
    if bronze_root and f"{qualified(spark, dest)}/".startswith(f"{qualified(spark, bronze_root)}/"):
        raise ValueError(f"{dest} lies inside bronze")
    read_documents(spark, src).write.mode("overwrite").parquet(dest)


def compact_bronze(spark: SparkSession, root: str, out: str, dt_from: str | None = None, dt_to: str | None = None,
                   partitions: int | None = None) -> DataFrame:
    """Rewrite bronze partitions into fewer, larger files under a new root,
    keeping every copy (row count is preserved; nothing is deduplicated).
    The date range prunes partitions at the scan. Rows are range-partitioned
    on (dt, batch, key, ingest time): small folders share a task, and a busy
    day is split over several tasks, with files sorted by key."""
    df = spark.read.parquet(root)
    if dt_from:
        df = df.where(F.col("dt") >= F.lit(dt_from).cast("date"))
    if dt_to:
        df = df.where(F.col("dt") <= F.lit(dt_to).cast("date"))
    keys = ["dt", "batch", "reading_id", "_ingested_at"]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("errorifexists").partitionBy("dt", "batch").parquet(out)
    return spark.read.parquet(out)


def write_lookup_table(df: DataFrame, path: str, key: str = "reading_id", prefix_len: int = 2,
                       partitions: int | None = None) -> None:
    """Lay a keyed table out by the first hex digits of an md5 key, so a
    point lookup reads one folder, and files inside are sorted by key so
    row-group statistics prune the rest. Range partitioning on the key keeps
    tasks balanced whatever the table size (each task covers a contiguous key
    range, i.e. one or two prefix folders)."""
    keyed = df.withColumn("key_prefix", F.substring(F.col(key), 1, prefix_len))
    ranged = keyed.repartitionByRange(partitions, key) if partitions else keyed.repartitionByRange(key)
    ranged.sortWithinPartitions(key).write.mode("errorifexists").partitionBy("key_prefix").parquet(path)


def lookup(spark: SparkSession, path: str, key_value: str, key: str = "reading_id", prefix_len: int = 2) -> DataFrame:
    return spark.read.parquet(path).where(
        (F.col("key_prefix") == key_value[:prefix_len]) & (F.col(key) == key_value)
    )
