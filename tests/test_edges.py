"""Edge rows: copies, ties, odd values, null keys, as-of bounds, thresholds."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from gaugeflow.functions.keys import mint_reading_id, sanitize_reading_id
from gaugeflow.functions.values import try_double
from gaugeflow.operators import checks, gold, silver
from gaugeflow.operators.asof import asof_lag
from tests.fixtures import NOW, reading, seed_dim, to_bronze

H = timedelta(hours=1)


def test_latest_copy_wins_and_ties_are_deterministic(spark):
    t = NOW - 5 * H
    rows = [
        reading("4009", t, 1.0, ingested=NOW - 3 * H),
        reading("4009", t, 2.0, ingested=NOW - 1 * H),  # newest ingest wins
        reading("4009", t, 3.0, ingested=NOW - 2 * H),
        # same ingest time: the later batch, then the larger value wins
        reading("4126", t, 5.0, ingested=NOW, batch="b1"),
        reading("4126", t, 6.0, ingested=NOW, batch="b2"),
        reading("4007", t, 7.0, ingested=NOW, batch="b"),
        reading("4007", t, None, ingested=NOW, batch="b"),
        reading("4007", t, 8.0, ingested=NOW, batch="b"),
    ]
    b = to_bronze(spark, rows)
    for method in ("window", "agg"):
        s = silver.build_silver(b, NOW, method=method)
        got = {r.station_reference: r.value for r in s.collect()}
        assert got == {"4009": 2.0, "4126": 6.0, "4007": 8.0}, method


def test_dedupe_idempotent_and_order_free(spark):
    rows = [reading("4009", NOW - i * H, float(i), ingested=NOW - (i % 3) * H) for i in range(20)]
    rows += [reading("4009", NOW - i * H, float(i) + 0.5, ingested=NOW) for i in range(0, 20, 4)]
    b = to_bronze(spark, rows)
    once = silver.build_silver(b, NOW).drop("silver_built_at")
    twice = silver.build_silver(
        b.unionByName(b).orderBy(F.rand(7)), NOW
    ).drop("silver_built_at")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


@pytest.mark.parametrize(
    "text,flag",
    [
        (None, "missing"),
        ("n/a", "missing"),
        ("NaN", "out_of_range"),
        ("-50", "ok"),
        ("50", "ok"),
        ("50.01", "out_of_range"),
        ("-50.01", "out_of_range"),
        (" 1.5 ", "ok"),
        ("1e3", "out_of_range"),
        ("1d", "missing"),
        ("1_000", "out_of_range"),  # digit groups with underscores parse (1000)
        ("1__0", "missing"),
        ("0x10", "missing"),
    ],
)
def test_value_cast_and_flag(spark, text, flag):
    r = reading("4009", NOW, None)
    r["value"] = text
    b = to_bronze(spark, [r])
    r = silver.build_silver(b, NOW).first()
    assert r.quality_flag == flag


def test_rows_without_key_parts_dropped(spark):
    rows = [reading("4009", None, 1.0), reading("4009", NOW, 1.0, measure=None), reading("4009", NOW, 1.0)]
    assert silver.build_silver(to_bronze(spark, rows), NOW).count() == 1


def test_minted_key_spells_null_as_none(spark):
    df = spark.createDataFrame([("m", None), (None, "t"), ("m", "t")], "measure string, date_time string")
    got = [r.k for r in df.select(mint_reading_id("measure", "date_time").alias("k")).collect()]
    import hashlib

    want = [hashlib.md5(s.encode()).hexdigest() for s in ("m|None", "None|t", "m|t")]
    assert got == want


def test_sanitize_reading_id(spark):
    df = spark.createDataFrame([("AB-12;drop",), ("zzz",)], "x string")
    got = [r.y for r in df.select(sanitize_reading_id("x").alias("y")).collect()]
    assert got == ["AB12d", None]


def test_asof_inclusive_bound_and_no_tolerance(spark):
    rows = [
        reading("4009", NOW, 1.0),
        reading("4009", NOW - 24 * H, 2.0),  # exactly 24 h before: taken
        reading("4009", NOW - 23 * H, 9.0),
        reading("4126", NOW, 1.0),
        reading("4126", NOW - 400 * H, 4.0),  # arbitrarily old: still taken
        reading("4007", NOW, 1.0),  # only a young reading: null
        reading("4007", NOW - 2 * H, 1.0),
    ]
    s = silver.build_silver(to_bronze(spark, rows), NOW)
    got = {r.station_reference: r.value_24h_ago for r in gold.gold_latest(s, seed_dim(spark)).collect()}
    assert got == {"4009": 2.0, "4126": 4.0, "4007": None}
    tol = asof_lag(gold.stage_rows(s), "measure", "date_time_utc", "value", "24 hours", tie="reading_id", tolerance="48 hours")
    got_tol = {r.station_reference: r.value_lag for r in tol.collect()}
    assert got_tol["4126"] is None and got_tol["4009"] == 2.0


def test_threshold_fallback_orphan_and_strictness(spark):
    dim = spark.createDataFrame(
        [("A", "a", None, 5.0, 9.0), ("B", "b", None, None, 1.0), ("C", "c", None, None, None)],
        "station_reference string, station_label string, river_name string, threshold_m double, typical_range_high double",
    )
    rows = [reading("A", NOW, 5.0), reading("B", NOW, 1.5), reading("C", NOW, 3.0), reading("Z", NOW, 3.0)]
    s = silver.build_silver(to_bronze(spark, rows), NOW)
    got = {r.station_reference: (r.threshold, r.above_threshold) for r in gold.gold_latest(s, dim).collect()}
    assert got == {"A": (5.0, False), "B": (1.0, True), "C": (None, None), "Z": (None, None)}
    res = {r.test_type + ":" + r.column_name: r for r in checks.run_checks(
        {"silver": s, "gold_series": gold.gold_series(s, NOW), "gold_station_latest": gold.gold_latest(s, dim), "dim_stations": dim}
    ).collect()}
    rel = res["relationships:station_reference"]
    assert (rel.failures, rel.status) == (1, "warn")


def test_unknown_parameter_warns_and_grain_conflict_fails(spark):
    rows = [
        reading("4009", NOW, 1.0, parameter="humidity"),
        reading("4009", NOW, 1.0, measure="m1"),
        reading("4009", NOW, 2.0, measure="m2"),
    ]
    s = silver.build_silver(to_bronze(spark, rows), NOW)
    latest = gold.gold_latest(s, seed_dim(spark))
    res = checks.run_checks({"silver": s, "gold_series": gold.gold_series(s, NOW), "gold_station_latest": latest, "dim_stations": seed_dim(spark)})
    by = {(r.model, r.test_type, r.column_name): r for r in res.collect()}
    assert by[("silver", "accepted_values", "parameter")].status == "warn"
    assert by[("gold_station_latest", "unique", "station_reference")].status == "fail"
    assert checks.summarize(res).first().publishable is False


def test_try_double_numeric_column_passthrough(spark):
    df = spark.createDataFrame([(1.5,)], "v double")
    assert df.select(try_double("v", df.schema["v"].dataType).alias("x")).first().x == 1.5


def test_hours_before_text(spark):
    from datetime import datetime

    from gaugeflow.functions import hours_before

    df = spark.createDataFrame([(datetime(2026, 6, 14, 3, 0, 0),)], "now timestamp_ntz")
    assert df.select(hours_before("now", 6).alias("s")).first().s == "2026-06-13T21:00:00Z"


def test_try_double_matches_sql_try_cast(spark):
    import math

    import duckdb

    cases = ["1_000", "1__0", "_1", "1_", "1_000.5", "1.0_5", "1e1_0", "1d", "0x1p3", "Infinity", "+inf", "-nan",
             "NaN", " 1.5 ", "1.", ".5", "1E+5", "+1", "-0", "1,5", "1 000", "\t2\n", "-Infinity", "1e", "e5", ".",
             "+", "1.5.2", "1f", " -2.5e-3 ", "+.5", "INF", "n/a", "", None, "1e400", "-1e400"]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    got = {r.v: r.x for r in df.select("v", try_double("v").alias("x")).collect()}
    for c in cases:
        want = duckdb.execute("select try_cast(? as double)", [c]).fetchone()[0]
        g = got[c]
        assert (g is None) == (want is None), c
        if g is not None:
            assert (math.isnan(g) and math.isnan(want)) or g == want, c
