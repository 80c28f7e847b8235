"""Run tables: merge on read, what a late row costs, compaction, withdrawal."""

import os
import random
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators import gold, silver
from gaugeflow.streaming import silver_stream
from gaugeflow.streaming.runs import FAN, RunTable
from tests.fixtures import NOW, reading, seed_dim, to_bronze

H = timedelta(hours=1)
SCHEMA = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("k", T.StringType()), T.StructField("at", T.LongType()), T.StructField("v", T.StringType())])


def files(root):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def runs_of(table):
    return {(r["p"], r["run"]): r["rows"] for r in table.live().collect()}


def test_runs_merge_to_the_last_row(spark, tmp_path):
    rng, table, all_rows = random.Random(4), RunTable(spark, f"{tmp_path}/t", "p", ("k",), ("at",), SCHEMA), []
    assert table.read().collect() == [] and table.append(spark.createDataFrame([], SCHEMA)) == []
    for batch in range(2 * FAN + 1):
        rows = [(rng.randint(0, 1), f"k{rng.randint(0, 15)}", rng.randint(0, 1000) if rng.random() < 0.9 else None, f"{batch}-{i}") for i in range(12)]
        rows = [(int(k[1:]) % 2, k, at, v) for _, k, at, v in rows]  # a key has one partition
        all_rows += rows
        table.append(spark.createDataFrame(rows, SCHEMA).repartition(3), f"b-{batch}")
        if batch == 2:
            table.append(spark.createDataFrame(rows, SCHEMA), f"b-{batch}")  # replayed
    want = {}
    for p, k, at, v in all_rows:
        want[k] = max(want.get(k, (False, -1, "", 0)), (at is not None, at or 0, v, p))
    got = {r["k"]: (r["at"], r["v"], r["p"]) for r in table.read().collect()}
    assert got == {k: (at if has else None, v, p) for k, (has, at, v, p) in want.items()}
    assert {r["p"] for r in table.read([1]).collect()} == {1}
    live = runs_of(table)
    assert all(sum(1 for p, _ in live if p == part) <= 2 * FAN for part in (0, 1)) and any(r.startswith("c-") for _, r in live)
    before = len(files(table.root))
    assert table.vacuum(1 << 60) > 0 and len(files(table.root)) < before
    assert {r["k"]: (r["at"], r["v"], r["p"]) for r in table.read().collect()} == got


def test_a_late_reading_costs_a_row_not_its_date(spark, tmp_path):
    root = f"{tmp_path}/silver"
    day = [reading("4009", NOW - timedelta(seconds=i), float(i % 40)) for i in range(4000)]
    silver_stream.merge_silver_batch(spark, to_bronze(spark, day), root)
    first = files(root)
    late = to_bronze(spark, [reading("4009", NOW - timedelta(seconds=7), 33.0, ingested=NOW + H)])
    silver_stream.merge_silver_batch(spark, late, root)
    new = {f: n for f, n in files(root).items() if f not in first}
    assert set(first) <= set(files(root)) and 0 < sum(new.values()) < sum(first.values()) / 4
    table = silver_stream.silver_table(spark, root)
    assert sorted(r["rows"] for r in table.live().collect())[0] == 1
    got = silver_stream.read_silver(spark, root)
    assert got.count() == 4000 and got.where("value = 33.0 AND date_time_utc = ingested_at - INTERVAL 1 HOURS - INTERVAL 7 SECONDS").count() == 1


def test_latest_after_late_and_withdrawn_values(spark, tmp_path):
    """Against a batch build after every micro-batch; a withdrawn value leaves the table."""
    root, latest, dim = f"{tmp_path}/silver", f"{tmp_path}/latest", seed_dim(spark)
    t = NOW - 2 * H
    batches = [
        [reading("4009", t - k * 5 * H, 1.0 + k) for k in range(9)] + [reading("4126", t - 30 * H, 2.0)],
        [reading("4009", t - 24 * H, 9.0), reading("4009", t - 25 * H, 8.0)],  # late, at and before the bound
        [reading("4009", t, None, ingested=NOW + H)],  # the newest value is withdrawn
        [reading("4126", t - 30 * H, None, ingested=NOW + H)],  # the only value is withdrawn
        [reading("4126", t, 3.0, ingested=NOW + 2 * H)],
    ]
    seen = []
    for batch in batches:
        b = to_bronze(spark, batch)
        seen += batch
        touched = silver_stream.merge_silver_batch(spark, b, root)
        silver_stream.refresh_latest_batch(spark, root, latest, touched, dim)
        want = gold.gold_latest(silver.build_silver(to_bronze(spark, seen), NOW), dim).select(*gold.LATEST_COLUMNS)
        got = silver_stream.read_latest(spark, latest)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert silver_stream.read_latest(spark, latest).count() == 2


def test_only_touched_buckets_are_read(spark, tmp_path):
    latest = f"{tmp_path}/latest"
    rows = spark.range(64).select(
        (F.col("id") % 16).cast("int").alias("bucket"), F.concat(F.lit("m"), "id").alias("measure"), F.lit(NOW).cast("date").alias("reading_date"),
        F.lit(1).cast("long").alias("version"), F.col("id").cast("string").alias("reading_id"),
        *[F.lit("x").alias(c) for c in ("station_reference", "station_label", "unit_name")],
        F.lit(NOW).cast("timestamp_ntz").alias("date_time_utc"), F.lit(1.0).alias("value"),
    )
    table = silver_stream.days_table(spark, latest)
    assert len(table.append(rows)) == 16
    some = table.read([3, 5])
    assert {r["bucket"] for r in some.collect()} == {3, 5} and some.count() == 8
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
