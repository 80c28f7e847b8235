import pytest
"""Streaming equals batch; replay is a no-op; publish is gated."""

import json
import os
import tempfile

from gaugeflow.operators import silver
from gaugeflow.plans import publish as pub
from gaugeflow.plans.catalog import AS_OF_BRONZE, AS_OF_SERIES
from gaugeflow.plans.pipeline import run_pipeline
from gaugeflow.sources import derived
from gaugeflow.streaming import bronze_stream, silver_stream
from tests.fixtures import golden_bronze, seed_dim

SF = "/root/testdata/sf0.001"


def test_payload_stream_lands_bronze_and_replay_is_noop(spark):
    base = tempfile.mkdtemp(prefix="gf-stream-")
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/a.json", "w") as f:
        f.write(json.dumps({"requested_station": "1", "items": [
            {"measure": "m1", "dateTime": "2026-06-14T16:15:00Z", "value": 1.0},
            {"measure": "m1", "dateTime": "2026-06-15T16:15:00Z", "value": 2.0}]}) + "\n")
    q = bronze_stream.start_ingest(spark, f"{base}/in", f"{base}/bronze", f"{base}/chk")
    q.awaitTermination()
    first = spark.read.parquet(f"{base}/bronze")
    assert first.count() == 2
    assert {r.dt.isoformat() for r in first.select("dt").collect()} == {"2026-06-14", "2026-06-15"}
    # replay the same input with a fresh checkpoint: same partitions rewritten, no duplicates
    q = bronze_stream.start_ingest(spark, f"{base}/in", f"{base}/bronze", f"{base}/chk2")
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/bronze").count() == 2


def test_stream_silver_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="gf-stream-")
    b = derived.bronze(spark, SF)
    from gaugeflow.operators.ingest import reading_date

    b.withColumn("dt", reading_date()).repartition(3).write.partitionBy("dt").parquet(f"{base}/bronze")
    q = silver_stream.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/chk", max_files=10)
    q.awaitTermination()
    streamed = silver_stream.read_silver(spark, f"{base}/silver")
    batch = silver.build_silver(b, with_build_stamp=False)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_publish_is_gated(spark):
    root = tempfile.mkdtemp(prefix="gf-pub-")
    good = run_pipeline(spark, SF, root, AS_OF_SERIES, AS_OF_BRONZE, bronze=golden_bronze(spark), dim=seed_dim(spark))
    assert good.published and pub.current_version(spark, root) == good.folder
    # the derived data has stations with two level measures: the grain test fails
    bad = run_pipeline(spark, SF, root, AS_OF_SERIES, AS_OF_BRONZE)
    assert not bad.published
    assert pub.current_version(spark, root) == good.folder  # last-known-good stays
    meta = spark.read.json(f"{good.folder}/run_meta").first()
    assert meta.tests_passed == 11 and meta.status == "ok"
    # readers resolve the pointer: they see the good run's tables, not the failed one's
    assert pub.read_published(spark, root, "gold_station_latest").count() == 2
    assert pub.read_published(spark, root, "series", fmt="json").count() == 6


def test_payload_to_silver_streams_equal_batch(spark):
    from gaugeflow.sources import payloads

    base = tempfile.mkdtemp(prefix="gf-chain-")
    ev = derived.load(spark, SF, "events")
    # two landing rounds: the second re-delivers a slice of the first with new values
    payloads.reading_payload_text(ev).write.mode("append").text(f"{base}/in")
    q = bronze_stream.start_ingest(spark, f"{base}/in", f"{base}/bronze", f"{base}/chk_b")
    q.awaitTermination()
    from pyspark.sql import functions as F

    again = ev.where(F.col("event_id") % 5 == 0).withColumn("value", F.col("value") + 1.0)
    payloads.reading_payload_text(again).write.mode("append").text(f"{base}/in")
    q = bronze_stream.start_ingest(spark, f"{base}/in", f"{base}/bronze", f"{base}/chk_b")
    q.awaitTermination()
    q = silver_stream.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/chk_s")
    q.awaitTermination()
    streamed = silver_stream.read_silver(spark, f"{base}/silver")
    bronze_all = spark.read.parquet(f"{base}/bronze").drop("dt", "batch")
    batch = silver.build_silver(bronze_all, with_build_stamp=False)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_pointer_is_replaced_in_one_step_and_views_follow_it(spark):
    from gaugeflow.plans import publish as pub
    from gaugeflow.sources.views import register_published

    root = tempfile.mkdtemp(prefix="gf-pointer-")
    for run_id, n in (("one", 1), ("two", 2)):
        spark.range(n).write.parquet(f"{pub.version_path(root, run_id)}/silver")
        pub.publish(spark, root, run_id, True)
        register_published(spark, root, {"silver_of_run": "silver"})
        assert spark.table("silver_of_run").count() == n
    with pytest.raises(Exception):
        pub.write_text(spark, f"{root}/missing-folder\0/x", "y")
    assert pub.current_version(spark, root).endswith("two")
    pub.expire_versions(spark, root, keep=1)
    assert spark.table("silver_of_run").count() == 2


def test_hot_measure_is_split(spark):
    """A key with 90 % of the rows is split in the join of the as-of lookup."""
    from pyspark.sql import functions as F

    from gaugeflow.operators.asof import asof_lag

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(300_000).select(
            F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("measure"),
            F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("at"),
            F.col("id").cast("string").alias("reading_id"),
            F.rand(1).alias("value"),
        )
        rows = rows.repartition(8)
        out = asof_lag(rows, "measure", "at", "value", tie="reading_id", cols=["measure", "at"])
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
