"""Forecast: guards, fit window, damping, ties."""

from datetime import timedelta

import numpy as np
import pytest

from gaugeflow.operators import forecast, gold, silver
from tests.fixtures import NOW, reading, to_bronze

M = timedelta(minutes=15)


def _series(spark, pts):
    rows = [reading("4009", NOW - k * M, v) for k, v in pts]
    return gold.gold_series(silver.build_silver(to_bronze(spark, rows), NOW), NOW)


@pytest.mark.parametrize("n,expect", [(3, 0), (4, 24), (5, 24)])
def test_min_points_guard(spark, n, expect):
    s = _series(spark, [(k, 1.0 + 0.01 * k) for k in range(n)])
    assert forecast.forecast_points(s).count() == expect


def test_recent_guard_and_values_match_least_squares(spark):
    # 6 old points (> 12 h before the latest) and 5 recent ones
    pts = [(k * 8, 2.0) for k in range(10, 16)] + [(k, 1.0 + 0.02 * k * k) for k in range(5)]
    s = _series(spark, pts)
    got = sorted(forecast.forecast_points(s).collect(), key=lambda r: r.k)
    assert len(got) == 24
    recent = sorted([(NOW - k * M, v) for k, v in pts if k * M <= timedelta(hours=12)])
    x = np.array([(t - recent[0][0]).total_seconds() for t, _ in recent])
    y = np.array([v for _, v in recent])
    slope = np.polyfit(x, y, 1)[0]
    last_v = recent[-1][1]
    for r in got:
        ds = r.k * 900
        assert r.value == pytest.approx(round(last_v + slope * ds * 0.97**r.k, 3), abs=1e-9)
        assert r.date_time_utc == NOW + timedelta(seconds=ds)


def test_too_few_recent_points(spark):
    pts = [(k, 1.0) for k in range(3)] + [(100 + k, 1.0) for k in range(10)]
    assert forecast.forecast_points(_series(spark, pts)).count() == 0


def test_equal_times_give_no_slope(spark):
    rows = [reading("4009", NOW, 1.0 + i, measure=f"m{i}") for i in range(5)]
    s = gold.gold_series(silver.build_silver(to_bronze(spark, rows), NOW), NOW)
    m = forecast.forecast_model(s).first()
    assert m.n_recent == 5 and m.eligible is False
    assert forecast.forecast_points(s).count() == 0
