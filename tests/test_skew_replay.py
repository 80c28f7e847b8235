"""Hot keys and replays."""

import tempfile
from datetime import timedelta

from pyspark.sql import functions as F

from gaugeflow.operators import gold, lineage, silver
from gaugeflow.streaming import silver_stream
from tests.fixtures import NOW, reading, seed_dim, to_bronze

H = timedelta(hours=1)


def _hot_bronze(spark, copies=3000):
    # one key holds most rows: many re-ingests of the same reading
    hot = [reading("4009", NOW, float(i % 40), ingested=NOW + i * timedelta(seconds=1)) for i in range(copies)]
    cold = [reading("4126", NOW - k * H, 1.0) for k in range(30)]
    return to_bronze(spark, hot + cold).repartition(8)


def test_hot_key_dedupes_to_newest_copy(spark):
    b = _hot_bronze(spark)
    for method in ("window", "agg"):
        s = silver.build_silver(b, NOW, method=method)
        hot = s.where(F.col("station_reference") == "4009").collect()
        assert len(hot) == 1 and hot[0].value == float(2999 % 40), method
        assert s.count() == 31
    copies = lineage.copy_summary(b).where(F.col("copies") > 1).first()
    assert copies.copies == 3000


def test_hot_key_plan_combines_before_shuffle(spark):
    b = _hot_bronze(spark)
    agg_plan = silver.build_silver(b, NOW, method="agg")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in agg_plan
    win_plan = silver.build_silver(b, NOW, method="window")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in win_plan and "WindowGroupLimit" in win_plan


def test_hot_measure_asof(spark):
    rows = [reading("4009", NOW - k * timedelta(minutes=15), float(k % 50)) for k in range(2000)]
    s = silver.build_silver(to_bronze(spark, rows).repartition(8), NOW)
    r = gold.gold_latest(s, seed_dim(spark)).first()
    assert r.latest_value == 0.0 and r.value_24h_ago == float(96 % 50)


def test_silver_merge_replay_is_noop(spark):
    root = tempfile.mkdtemp(prefix="gf-merge-") + "/silver"
    t = NOW - 5 * H
    first = to_bronze(spark, [reading("4009", t, 1.0, ingested=NOW - 2 * H), reading("4126", t, 2.0)])
    late = to_bronze(spark, [reading("4009", t, 3.0, ingested=NOW - H)])
    stale = to_bronze(spark, [reading("4009", t, 9.0, ingested=NOW - 3 * H)])
    silver_stream.merge_silver_batch(spark, first, root)
    silver_stream.merge_silver_batch(spark, late, root)
    silver_stream.merge_silver_batch(spark, late, root)  # replayed micro-batch
    silver_stream.merge_silver_batch(spark, stale, root)  # late-arriving older copy
    got = {r.station_reference: r.value for r in silver_stream.read_silver(spark, root).collect()}
    assert got == {"4009": 3.0, "4126": 2.0}


def test_silver_merge_prunes_to_touched_dates(spark):
    root = tempfile.mkdtemp(prefix="gf-merge-") + "/silver"
    days = [to_bronze(spark, [reading("4009", NOW - timedelta(days=k), float(k))]) for k in range(3)]
    for b in days:
        silver_stream.merge_silver_batch(spark, b, root)
    stored = spark.read.schema(silver_stream._stored_schema()).parquet(root)
    q = stored.where(F.col("reading_date").isin([NOW.date()]))
    plan = q._jdf.queryExecution().executedPlan().toString()
    part = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "reading_date" in part and ("= 2026-06-14" in part or "IN (2026-06-14)" in part)
    assert silver_stream.read_silver(spark, root).count() == 3
