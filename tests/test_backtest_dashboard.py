"""Trend at every reading, forecasts against what came, station documents, the trace function."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from gaugeflow.config import FORECAST_METHOD
from gaugeflow.operators.backtest import backtest, backtest_summary, rolling_trend
from gaugeflow.operators.dashboard import station_documents
from gaugeflow.operators.forecast import forecast_model, forecast_points
from gaugeflow.session import scratch_path

T0 = datetime(2024, 1, 1, 5, 7)
SCHEMA = "station_reference string, station_label string, date_time_utc timestamp_ntz, value double, reading_id string"


def readings(n=400, seed=3):
    """A hot station, ties in time, gaps of days, fractions of seconds, nulls anywhere."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        station = rng.choice(["hot", "hot", "hot", "a", "b", None])
        at = T0 + timedelta(days=rng.choice([0, 1, 5]), minutes=15 * rng.randint(0, 95), milliseconds=rng.choice([0, 0, 125]))
        rows.append((station, f"label {station}", None if rng.random() < 0.03 else at, None if rng.random() < 0.05 else round(rng.uniform(-5, 40), 2), f"{i:05}"))
    return rows


def brute_trend(rows, hours=12, least=4):
    out = {}
    pts = [r for r in rows if None not in (r[0], r[2], r[3])]
    for s, at in {(r[0], r[2]) for r in pts}:
        near = [r for r in pts if r[0] == s and at - timedelta(hours=hours) <= r[2] <= at]
        value = max((r for r in near if r[2] == at), key=lambda r: r[4])[3]
        x = np.array([(r[2] - at).total_seconds() for r in near])
        y = np.array([r[3] for r in near])
        x, y = x - x.mean(), y - y.mean()
        fitted = len(near) >= least and len({r[2] for r in near}) > 1
        out[s, at] = (value, len(near), float(x @ y / (x @ x)) if fitted else None)
    return out


def test_rolling_trend_is_the_fit_of_each_window(spark):
    rows = readings()
    want = brute_trend(rows)
    got = rolling_trend(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    assert len(got) == len(want) > 150
    for r in got:
        value, n, slope = want[r.station_reference, r.date_time_utc]
        assert (r.value, r.n_recent) == (value, n)
        assert (r.slope is None) == (slope is None)
        assert slope is None or r.slope == pytest.approx(slope, rel=1e-6, abs=1e-10)


def test_newest_trend_is_the_forecast_model(spark):
    frame = spark.createDataFrame([r for r in readings() if r[0] and r[2]], SCHEMA)
    newest = {}
    for r in rolling_trend(frame).collect():
        if r.station_reference not in newest or r.date_time_utc > newest[r.station_reference].date_time_utc:
            newest[r.station_reference] = r
    for m in forecast_model(frame).collect():
        r = newest[m.station_reference]
        assert (r.date_time_utc, r.value, r.n_recent) == (m.last_at, m.last_value, m.n_recent)
        assert r.slope == (pytest.approx(m.slope, rel=1e-6) if m.eligible else None)


def test_backtest_projects_the_older_trend(spark):
    rows = readings()
    trend = brute_trend(rows)
    tested = backtest(spark.createDataFrame(rows, SCHEMA))
    got = tested.collect()
    assert len(got) == len(trend)
    some = 0
    for r in got:
        older = [at for s, at in trend if s == r.station_reference and at <= r.date_time_utc - timedelta(hours=6)]
        older = [at for at in older if at >= r.date_time_utc - timedelta(hours=7)]
        model = trend[r.station_reference, max(older)] if older else None
        if model is None or model[2] is None:
            assert (r.made_at, r.predicted, r.error) == (None, None, None)
            continue
        ds = (r.date_time_utc - max(older)).total_seconds()
        said = model[0] + model[2] * ds * 0.97 ** (ds / 900)
        assert r.made_at == max(older)
        assert r.predicted == pytest.approx(said, abs=2e-3) and r.error == pytest.approx(r.value - said, abs=2e-3)
        some += 1
    assert some > 50
    summary = {r.station_reference: r for r in backtest_summary(tested).collect()}
    assert sum(r.n_tested for r in summary.values()) == some
    assert all(r.mean_abs_error >= abs(r.bias) for r in summary.values() if r.n_tested)


def test_backtest_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert backtest(empty).collect() == [] and rolling_trend(empty).columns == ["station_reference", "date_time_utc", "value", "n_recent", "slope"]


def test_one_exchange_fits_every_instant(spark):
    frame = spark.createDataFrame(readings(), SCHEMA)
    plan = rolling_trend(frame)._jdf.queryExecution().executedPlan().toString()
    # One to combine an instant, one to bring a block together; both running sums share it.
    assert plan.count("Exchange hashpartitioning") == 2 and "_block" in plan


@pytest.mark.parametrize("ranges", [None, 1, 9])
def test_station_documents(spark, ranges):
    rows = readings()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    ahead = forecast_points(frame.where("station_reference IS NOT NULL AND date_time_utc IS NOT NULL"), fit_hours=720)
    steps = {}
    for r in ahead.collect():
        steps.setdefault(r.station_reference, []).append((r.date_time_utc.strftime("%Y-%m-%d %H:%M:%S"), r.value, "forecast"))
    path = scratch_path(spark, "documents")
    station_documents(frame, ahead, chunk_points=40, ranges=ranges).write.option("ignoreNullFields", "false").json(path)
    docs = [json.loads(r.value) for r in spark.read.text(path).collect()]
    for station in {r[0] for r in rows}:
        own = sorted((d for d in docs if d["station_reference"] == station), key=lambda d: d["chunk"])
        points = sorted((r for r in rows if r[0] == station), key=lambda r: (r[2] is not None, r[2] or T0, r[4]))
        assert [d["chunk"] for d in own] == list(range(-(-len(points) // 40)))
        assert all(d["chunks"] == len(own) and d["first_position"] == 40 * d["chunk"] for d in own)
        assert all(len(d["series"]) == 40 for d in own[:-1]) and 1 <= len(own[-1]["series"]) <= 40
        assert [p["reading_id"] for d in own for p in d["series"]] == [r[4] for r in points]
        assert [p["value"] for d in own for p in d["series"]] == [r[3] for r in points]
        assert [(s["date_time_utc"], s["value"], s["kind"]) for s in own[0]["forecast"]] == sorted(steps.get(station, []))
        assert all(d["forecast"] == [] for d in own[1:]) and {d["forecast_method"] for d in own} == {FORECAST_METHOD}
    assert station_documents(frame.limit(0), ahead.limit(0)).collect() == []


def test_trace_function_reads_by_key(spark):
    from gaugeflow.operators import trace
    from gaugeflow.plans import catalog, publish
    from gaugeflow.sources import views

    sf = "/root/testdata/sf0.001"
    root = catalog._published_root(spark, sf)
    views.register_catalog(spark, root, prefix="traced_")
    layer = lambda name: publish.read_published(spark, root, name)
    bronze, silver, series = layer("bronze_window"), layer("silver"), layer("gold_series")
    keys = [r.reading_id for r in series.orderBy("reading_id").limit(2).collect()]
    keys += [silver.where("quality_flag <> 'ok'").orderBy("reading_id").first().reading_id, "no such", "", "' OR 1=1 --"]
    for key in keys:
        got = spark.sql("SELECT * FROM traced_trace(:rid)", args={"rid": f"  {key}\n"})
        want = trace.trace_by_id(bronze, silver, series, key)
        assert got.columns == want.columns and [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    plan = spark.sql("SELECT * FROM traced_trace(:rid)", args={"rid": keys[0]})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(reading_id,") == 3 and "Join" not in plan
