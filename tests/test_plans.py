"""Plan shape: one shuffle for silver, pushdown at the scan, no sort-merge join in gold latest."""

import tempfile

from gaugeflow.operators import gold, silver
from gaugeflow.sources import derived
from gaugeflow.sources.views import point_lookup, register_published

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_has_one_exchange(spark):
    s = silver.build_silver(derived.bronze(spark, SF))
    plan = _plan(s)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan  # partial limit before the shuffle


def test_stage_filter_and_point_lookup_push_down(spark):
    out = tempfile.mkdtemp(prefix="gf-plan-")
    s = silver.build_silver(derived.bronze(spark, SF), with_build_stamp=False)
    s.write.mode("overwrite").parquet(f"{out}/silver")
    st = gold.stage_rows(spark.read.parquet(f"{out}/silver"))
    plan = _plan(st)
    assert "PushedFilters: [IsNotNull(parameter), IsNotNull(qualifier), IsNotNull(quality_flag), EqualTo(parameter,level)" in plan
    register_published(spark, out, {"silver_view": "silver"})
    rid = s.first().reading_id
    q = point_lookup(spark, "silver_view", rid)
    assert q.count() == 1
    assert "EqualTo(reading_id," in _plan(q)


def test_gold_latest_without_sort_merge_join(spark):
    s = silver.build_silver(derived.bronze(spark, SF))
    g = gold.gold_latest(s, derived.stations(spark, SF))
    g.collect()
    final = g._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in final


def test_literal_trace_pushes_key_to_every_layer(spark):
    from gaugeflow.operators import trace

    out = tempfile.mkdtemp(prefix="gf-trace-")
    b = derived.bronze(spark, SF)
    s = silver.build_silver(b, with_build_stamp=False)
    b.write.parquet(f"{out}/bronze")
    s.write.parquet(f"{out}/silver")
    gold.gold_series(spark.read.parquet(f"{out}/silver"), None, days=100000).write.parquet(f"{out}/series")
    rb, rs, rg = (spark.read.parquet(f"{out}/{n}") for n in ("bronze", "silver", "series"))
    rid = rg.first().reading_id
    t = trace.trace_by_id(rb, rs, rg, rid + "'; --xyz")
    row = t.first()
    assert row.reading_id == rid and row.copies >= 1 and row.quality_flag == "ok"
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"EqualTo(reading_id,{rid})") >= 3
    assert trace.trace_by_id(rb, rs, rg, "zzz").count() == 0


def test_windows_prune_date_partitions(spark):
    from datetime import datetime

    from pyspark.sql import functions as F

    from gaugeflow.operators.ingest import bronze_window, reading_date

    out = tempfile.mkdtemp(prefix="gf-prune-")
    b = derived.bronze(spark, SF)
    s = silver.build_silver(b, with_build_stamp=False).withColumn("reading_date", F.to_date("date_time_utc"))
    s.write.partitionBy("reading_date").parquet(f"{out}/silver")
    b.withColumn("dt", reading_date()).write.partitionBy("dt").parquet(f"{out}/bronze")
    series = gold.gold_series(spark.read.parquet(f"{out}/silver"), datetime(2024, 2, 10))
    plan = _plan(series)
    assert "PartitionFilters: [isnotnull(reading_date" in plan and "reading_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert series.count() == gold.gold_series(silver.build_silver(b, with_build_stamp=False), datetime(2024, 2, 10)).count()
    w = bronze_window(spark.read.parquet(f"{out}/bronze"), datetime(2024, 4, 10), 90)
    part = _plan(w).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "dt" in part and ">=" in part
    assert w.count() == bronze_window(b, datetime(2024, 4, 10), 90).count()


def test_lineage_prunes_bronze_dates(spark):
    from datetime import datetime

    from gaugeflow.operators import lineage
    from gaugeflow.operators.ingest import reading_date

    out = tempfile.mkdtemp(prefix="gf-linprune-")
    b = derived.bronze(spark, SF)
    b.withColumn("dt", reading_date()).write.partitionBy("dt").parquet(f"{out}/bronze")
    rb = spark.read.parquet(f"{out}/bronze")
    s = silver.build_silver(b, with_build_stamp=False)
    series = gold.gold_series(s, datetime(2024, 2, 10))
    flat = lineage.lineage_flat(rb, s, series)
    flat.collect()
    plan = flat._jdf.queryExecution().executedPlan().toString()
    filters = [p.split("], PushedFilters", 1)[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("dt#" in f and "Subquery" in f for f in filters)
    same = lineage.lineage_flat(b, s, series)
    assert flat.exceptAll(same).count() == 0 and same.exceptAll(flat).count() == 0


def test_trace_builds_no_layer(spark):
    """A literal key reaches the events scan side of every layer: silver is deduped for the key alone."""
    from gaugeflow.operators import trace
    from gaugeflow.plans.catalog import AS_OF_SERIES, layers

    L = layers(spark, "/root/testdata/sf0.001", materialize=False)
    same = trace.most_copied_plotted_key(L.bronze, L.series).first()
    assert trace.most_copied_in_one_pass(L.bronze, AS_OF_SERIES).first() == same
    found = trace.trace_by_id(L.bronze, L.silver, L.series, same["reading_id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Window ")[1:]
    assert above and all(f"= {same['reading_id']}" in part for part in above)
    assert found.count() == 1
