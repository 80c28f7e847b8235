"""Golden values of the two-station fixture, worked by hand."""

from datetime import timedelta

from pyspark.sql import functions as F

from gaugeflow.operators import checks, forecast, gold, lineage, silver
from tests.fixtures import NOW, golden_bronze, seed_dim


def _layers(spark):
    b = golden_bronze(spark)
    s = silver.build_silver(b, NOW)
    series = gold.gold_series(s, NOW)
    latest = gold.gold_latest(s, seed_dim(spark))
    return b, s, series, latest


def test_silver_all_ok(spark):
    _, s, _, _ = _layers(spark)
    rows = s.collect()
    assert len(rows) == 6
    assert {r.quality_flag for r in rows} == {"ok"}


def test_series_has_six_rows(spark):
    _, _, series, _ = _layers(spark)
    assert series.count() == 6


def test_latest_change_and_threshold(spark):
    _, _, _, latest = _layers(spark)
    rows = {r.station_reference: r for r in latest.collect()}
    assert set(rows) == {"4009", "4126"}
    for st, th in (("4009", 3.6), ("4126", 2.9)):
        r = rows[st]
        assert r.latest_value == 1.0
        assert r.value_24h_ago == 1.1  # the bound is inclusive
        assert r.change_24h == -0.1
        assert r.threshold == th
        assert r.above_threshold is False
        assert r.latest_at == NOW


def test_no_forecast_with_three_points(spark):
    _, _, series, _ = _layers(spark)
    assert forecast.forecast_points(series).count() == 0


def test_lineage_one_copy_each(spark):
    b, s, series, _ = _layers(spark)
    flat = lineage.lineage_flat(b, s, series).collect()
    assert len(flat) == 6
    assert {r.copies for r in flat} == {1}


def test_all_eleven_checks_pass(spark):
    b, s, series, latest = _layers(spark)
    res = checks.run_checks({"silver": s, "gold_series": series, "gold_station_latest": latest, "dim_stations": seed_dim(spark)})
    rows = res.collect()
    assert len(rows) == 11
    assert all(r.status == "pass" for r in rows), [r for r in rows if r.status != "pass"]
    summ = checks.summarize(res).first()
    assert (summ.tests_passed, summ.tests_total, summ.publishable) == (11, 11, True)


def test_window_cutoff_inclusive(spark):
    _, s, _, _ = _layers(spark)
    # as_of chosen so the oldest reading sits exactly on the 30-day cutoff
    as_of = NOW - timedelta(hours=48) + timedelta(days=30)
    assert gold.gold_series(s, as_of).count() == 6
    assert gold.gold_series(s, as_of + timedelta(seconds=1)).count() == 4
    assert gold.gold_series(s, NOW).where(F.col("value").isNull()).count() == 0
