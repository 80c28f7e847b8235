"""As-of from every row, against a plain scan, over many ranges and a hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeflow.operators.asof import asof_every

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, part int, at timestamp_ntz, id string, v double, row string"


def plain(rows, lag, tolerance=None):
    out = []
    for k, part, at, i, v, note in rows:
        best = None
        if k is not None and part is not None and at is not None:
            near = [r for r in rows if (r[0], r[1]) == (k, part) and r[2] is not None and r[2] <= at - lag]
            near = [r for r in near if tolerance is None or r[2] >= at - lag - tolerance]
            best = max(near, key=lambda r: (r[2], r[3]))[4] if near else None
        out.append((k, part, at, i, v, note, best))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges, tolerance", [(None, None), (1, None), (23, None), (23, 40)])
def test_every_row_looks_back(spark, ranges, tolerance):
    rng = random.Random(7)
    rows = []
    for i in range(500):
        hot = rng.random() < 0.6  # many ties in time; the hot key spans most ranges
        k = "hot" if hot else rng.choice(["a", "b", None])
        at = None if rng.random() < 0.03 else T0 + timedelta(minutes=rng.randint(0, 120))
        rows.append((k, rng.choice([1, None]) if k == "b" else 1, at, f"{i:04}", None if rng.random() < 0.1 else float(i), f"n{i}"))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = asof_every(frame, ["k", "part"], "at", "v", lag="30 minutes", tie="id", out_col="before", ranges=ranges,
                     tolerance=None if tolerance is None else f"{tolerance} minutes")
    assert got.columns == [*frame.columns, "before"]
    want = plain(rows, timedelta(minutes=30), None if tolerance is None else timedelta(minutes=tolerance))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_no_window_over_a_hot_key(spark):
    """Rows are windowed per (range, key), so a key with most rows is many groups of a range's size."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 20 == 0, "cold").otherwise("hot").alias("k"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("at"),
        F.col("id").cast("string").alias("row"),
        F.col("id").cast("double").alias("v"),
    )
    out = asof_every(rows, "k", "at", "v", lag="1 hours", tie="row", ranges=20)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line]
    assert any("_range" in w and "_inside" in w for w in windows)
    assert all("_range" in w.split("AS _")[-1] for w in windows)
    assert out.where("k = 'hot' AND value_lag IS NULL").count() == 57  # the first hour, every 20th row is cold
    assert asof_every(rows.limit(0), "k", "at", "v").collect() == []
