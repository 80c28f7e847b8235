"""Bronze landed by run date, with readings stamped after their run."""

from datetime import datetime

from pyspark.sql import functions as F

from gaugeflow.operators import gold, ingest, lineage, silver
from gaugeflow.plans import publish as pub
from gaugeflow.plans.pipeline import run_pipeline
from gaugeflow.sinks.landing import land_bronze
from tests.fixtures import NOW, golden_bronze, seed_dim


def test_readings_after_their_run_are_kept(spark, tmp_path):
    root = f"{tmp_path}/bronze"
    land_bronze(golden_bronze(spark).drop("_ingested_at", "_source_batch_id"), root, "2026-01-01T00:00:00Z", by="run")
    b = spark.read.parquet(root)
    assert b.select("dt").distinct().count() == 1
    s = silver.build_silver(b, NOW)
    series = gold.gold_series(s, NOW)
    n = series.count()
    assert n > 0
    assert lineage.lineage_flat(b, s, series, by="run").where("copies > 0").count() == n
    nested = lineage.lineage_nested(b, s, series, by="run")
    assert nested.where("lineage.bronze.copies > 0").count() == n
    assert lineage.lineage_records(b, series, by="run").select("reading_id").distinct().count() == n
    assert ingest.bronze_window(b, NOW, 90, by="run").count() == b.where(F.col("date_time").cast("timestamp_ntz") >= F.lit(NOW).cast("timestamp_ntz") - F.expr("INTERVAL 90 DAYS")).count() > 0
    done = run_pipeline(spark, "", f"{tmp_path}/out", NOW, NOW, bronze=b, dim=seed_dim(spark), layout="run")
    assert spark.read.parquet(f"{done.folder}/lineage_records").select("reading_id").distinct().count() == n
    assert pub.current_version(spark, f"{tmp_path}/out") == done.folder
    assert isinstance(NOW, datetime)
