"""Incremental landing of payload files into bronze (Structured Streaming).

``readStream`` over the lines of the payload folder → ``foreachBatch``: documents cut
from the micro-batch's splits → flatten → bronze partitioned by ``(dt, batch)``
with dynamic partition overwrite. A micro-batch holds whole files, so it holds whole documents.

* ``_ingested_at`` / ``_source_batch_id`` come from the input file's
  modification time (to the microsecond, so deliveries of one second keep
  their order) and ``batch`` from that stamp plus a digest of the file
  path, so a replayed micro-batch writes exactly the same partitions and
  leaves every other batch alone: a replay is a no-op, never a duplicate.
* A streaming *file sink* is not used: its ``_spark_metadata`` log would hide
  files that other writers append to the same bronze root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gaugeflow.functions.timefns import batch_name, iso_z
from gaugeflow.operators.ingest import reading_date
from gaugeflow.schemas import READING_PAYLOAD
from gaugeflow.sources.documents import cut_documents, text_lines
from gaugeflow.sources.payloads import flatten_readings


def stamp_from_file(df: DataFrame) -> DataFrame:
    """Run stamp and partition columns derived from the input file."""
    stamp = F.date_format("_file_mtime", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    second = iso_z(F.col("_file_mtime"))
    return (
        df.withColumn("value", F.col("value").cast("string"))  # one bronze schema for every writer
        .withColumn("_ingested_at", stamp)
        .withColumn("_source_batch_id", stamp)
        .withColumn("dt", reading_date())
        .withColumn("batch", F.concat(batch_name(second), F.lit("_"), F.substring(F.md5(F.col("_file")), 1, 10)))
        .drop("_file", "_file_mtime")
    )


def write_bronze_batch(batch: DataFrame, bronze_root: str, written: Observation | None = None) -> None:
    """Dynamic overwrite of exactly the ``(dt, batch)`` partitions present. Rows
    are clustered by folder first (a large folder is split by AQE). ``written``
    observes ``rows`` behind that shuffle, in the stage that writes, where
    a task that ran again counts once."""
    rows = batch.hint("rebalance", "dt", "batch")
    if written is not None:
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch")
        .parquet(bronze_root)
    )


def landed_batch(lines: DataFrame) -> DataFrame:
    """Bronze rows (with ``dt`` / ``batch``) of the payload files whose lines these are."""
    documents = cut_documents(lines)
    raw = documents.select(F.from_json("json", READING_PAYLOAD).alias("p"), F.col("file").alias("_file"), F.col("modified").alias("_file_mtime"))
    return stamp_from_file(flatten_readings(raw.select("p.*", "_file", "_file_mtime"), keep=("_file", "_file_mtime")))


def start_ingest(
    spark: SparkSession,
    payload_dir: str,
    bronze_root: str,
    checkpoint: str,
    available_now: bool = True,
    max_files: int | None = None,
    every: str = "3 hours",
):
    """Start the landing stream; returns the ``StreamingQuery``. Files are split
    like those of a batch; text outside documents stops the stream."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    w = (
        text_lines(reader.text(payload_dir))
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda lines, _epoch: write_bronze_batch(landed_batch(lines), bronze_root))
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
