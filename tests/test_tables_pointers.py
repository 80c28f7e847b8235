"""Bucketed tables that share a partitioning, and publishers that meet."""

import threading

import pytest

from gaugeflow.operators import checks, lineage, silver
from gaugeflow.plans import catalog
from gaugeflow.plans import publish as pub
from gaugeflow.sinks.tables import save_bucketed

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nothing_keyed_is_exchanged(spark, no_broadcast):
    layers = catalog.bucketed_layers(spark, SF, prefix="shared_", buckets=6)
    keyed = {
        "lineage": lineage.lineage_flat(layers.bronze, layers.silver, layers.series),
        "dedupe": silver.dedupe_keep_latest_agg(silver.typed_readings(layers.bronze)),
        "window": silver.dedupe_keep_latest_window(silver.typed_readings(layers.bronze)),
        "semi": lineage.bronze_of_series(layers.bronze, layers.series),
        "copies": lineage.copy_summary(layers.bronze),
    }
    for name, df in keyed.items():
        assert "Exchange" not in plan_of(df), name
        assert "Bucketed: true" in df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")), name
    plain = catalog.layers(spark, SF)
    want = lineage.lineage_flat(plain.bronze, plain.silver, plain.series)
    assert "Exchange hashpartitioning(reading_id" in plan_of(want)
    assert sorted(map(tuple, keyed["lineage"].collect())) == sorted(map(tuple, want.collect()))
    unique = checks.run_checks({"silver": layers.silver, "gold_series": layers.series, "gold_station_latest": plain.latest, "dim_stations": plain.dim})
    assert {r.test_id: r.failures for r in unique.collect()}["test.unique_silver_reading_id"] == 0


def test_bucketed_table_of_nulls_and_of_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("a", 3)], "reading_id string, n int")
    again = [save_bucketed(rows, "edge_rows", f"{tmp_path}/{i}", buckets=3) for i in range(2)]  # replaced by name
    assert sorted(r.n for r in again[-1].collect()) == [1, 2, 3]
    assert save_bucketed(rows.limit(0), "edge_empty", f"{tmp_path}/empty", buckets=3).collect() == []


def test_concurrent_publishers_lose_no_version(spark, tmp_path):
    root, runs = f"{tmp_path}/out", [f"run-{i:02}" for i in range(16)]
    for run_id in runs:
        spark.range(1).coalesce(1).write.parquet(f"{pub.version_path(root, run_id)}/t")
    assert pub.current_version(spark, root) is None
    gate, seen = threading.Barrier(8), []

    def work(mine):
        gate.wait()
        for run_id in mine:
            assert pub.publish(spark, root, run_id, True)
            seen.append(pub.current_version(spark, root))  # always a whole version

    threads = [threading.Thread(target=work, args=(runs[i::8],)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = pub.published_log(spark, root)
    assert sorted(run_id for _, run_id in log) == runs and len(seen) == 16
    assert set(seen) <= {pub.version_path(root, r) for r in runs}
    assert pub.current_version(spark, root) == pub.version_path(root, max(log)[1])
    assert not pub.publish(spark, root, "bad", False) and pub.published_log(spark, root) == log
    pub.publish(spark, root, "run-00", True)  # back to an older version
    assert pub.current_version(spark, root) == pub.version_path(root, "run-00")


def test_pointer_of_earlier_releases(spark, tmp_path):
    root = f"{tmp_path}/out"
    pub.write_text(spark, f"{root}/CURRENT", "old")
    assert pub.current_version(spark, root) == pub.version_path(root, "old")
    pub.publish(spark, root, "new", True)
    assert pub.current_version(spark, root) == pub.version_path(root, "new")
