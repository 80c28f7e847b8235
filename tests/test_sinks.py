"""Landing layout, heartbeat, compaction, lookup layout."""

import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators.metrics import heartbeat_health
from gaugeflow.sinks import landing
from tests.fixtures import NOW, reading, to_bronze


def test_land_bronze_appends_and_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="gf-land-")
    rows = [reading("4009", NOW, 1.0), reading("4009", None, 2.0)]
    df = to_bronze(spark, rows).drop("_ingested_at", "_source_batch_id")
    landing.land_bronze(df, root, "2026-06-14T18:00:00Z")
    landing.land_bronze(df, root, "2026-06-14T21:00:00Z")
    landing.land_bronze(df, root, "2026-06-14T21:00:00Z")  # retried batch: no duplicate
    b = spark.read.parquet(root)
    assert b.count() == 4
    assert b.where(F.col("dt").isNull()).count() == 2  # null reading time kept in the default partition
    assert {r.batch for r in b.select("batch").distinct().collect()} == {"batch_20260614T180000Z", "batch_20260614T210000Z"}
    out = landing.compact_bronze(spark, root, root + "_compacted")
    assert out.count() == 4


def test_heartbeat_and_staleness(spark):
    root = tempfile.mkdtemp(prefix="gf-hb-")
    landing.write_heartbeat(spark, root, "2026-06-14T10:00:00Z", 5, "bronze/dt=2026-06-14/x.parquet")
    fresh = heartbeat_health(spark, f"{root}/_latest.json", datetime(2026, 6, 14, 15, 0)).first()
    stale = heartbeat_health(spark, f"{root}/_latest.json", datetime(2026, 6, 14, 16, 1)).first()
    assert (fresh.age_minutes, fresh.health_status) == (300, "last-known-good")
    assert stale.health_status == "stale"
    missing = heartbeat_health(spark, f"{root}/nothing.json", datetime(2026, 6, 14, 16, 1)).first()
    assert missing.health_status == "last-known-good" and missing.age_minutes is None


def test_lookup_layout(spark):
    path = tempfile.mkdtemp(prefix="gf-lookup-") + "/t"
    df = spark.range(200).select(F.md5(F.col("id").cast("string")).alias("reading_id"), F.col("id"))
    landing.write_lookup_table(df, path)
    key = df.orderBy("id").first().reading_id
    hit = landing.lookup(spark, path, key)
    assert hit.count() == 1
    assert "PartitionFilters: [isnotnull(key_prefix" in hit._jdf.queryExecution().executedPlan().toString()


def test_copy_raw_feed_views_and_ordered_series(spark):
    import json
    import os

    from gaugeflow.operators.gold import ordered_series
    from gaugeflow.sources.views import register_layers

    base = tempfile.mkdtemp(prefix="gf-raw-")
    os.makedirs(f"{base}/feed")
    with open(f"{base}/feed/latest.json", "w") as f:
        f.write(json.dumps({"items": [{"measure": "m1", "value": 1.5}]}) + "\n")
    landing.copy_raw_feed(spark, f"{base}/feed", f"{base}/evidence")
    landing.copy_raw_feed(spark, f"{base}/feed", f"{base}/evidence")  # a retry replaces the copy
    copied = spark.read.parquet(f"{base}/evidence").collect()
    assert [json.loads(r.json) for r in copied] == [{"items": [{"measure": "m1", "value": 1.5}]}]
    with pytest.raises(ValueError):
        landing.copy_raw_feed(spark, f"{base}/feed", f"{base}/bronze/raw", bronze_root=f"{base}/bronze")

    rows = [reading("4009", NOW - k * timedelta(hours=1), float(k)) for k in (3, 1, 2)]
    from gaugeflow.operators import gold, silver

    s = silver.build_silver(to_bronze(spark, rows), NOW)
    series = gold.gold_series(s, NOW)
    register_layers({"gold_series_v": series})
    assert spark.sql("SELECT count(*) AS n FROM gold_series_v").first().n == 3
    assert [r.value for r in ordered_series(series).collect()] == [3.0, 2.0, 1.0]
