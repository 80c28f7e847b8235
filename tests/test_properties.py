"""Property tests: random small fixtures against a plain-Python brute force."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gaugeflow.operators import gold, silver
from tests.fixtures import NOW, reading, seed_dim, to_bronze

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

copies = st.lists(
    st.tuples(
        st.sampled_from(["4009", "4126"]),  # station
        st.integers(0, 5),  # reading slot (hours back)
        st.integers(0, 3),  # ingest offset (hours)
        st.sampled_from(["b1", "b2"]),  # batch
        st.one_of(st.none(), st.integers(-60, 60).map(float)),  # value
    ),
    min_size=1,
    max_size=25,
)


def _order_key(c):
    _, _, ing, batch, value = c
    # newest ingest, then later batch, then larger value with nulls last
    return (ing, batch, value is not None, value if value is not None else 0.0)


@SETTINGS
@given(copies)
def test_dedupe_matches_brute_force(spark, cs):
    rows = [reading(s, NOW - timedelta(hours=slot), v, ingested=NOW + timedelta(hours=ing), batch=b) for s, slot, ing, b, v in cs]
    b = to_bronze(spark, rows)
    want = {}
    for c in cs:
        k = (c[0], c[1])
        if k not in want or _order_key(c) > _order_key(want[k]):
            want[k] = c
    expect = sorted((s, NOW - timedelta(hours=slot), v) for (s, slot), (_, _, _, _, v) in want.items())
    for method in ("window", "agg"):
        got = sorted(
            (r.station_reference, r.date_time_utc, r.value)
            for r in silver.build_silver(b, NOW, method=method, with_build_stamp=False).collect()
        )
        assert got == expect, method


readings = st.lists(
    st.tuples(st.sampled_from(["4009", "4126"]), st.integers(0, 80), st.integers(-40, 40).map(float)),
    min_size=1,
    max_size=30,
    unique_by=lambda t: (t[0], t[1]),
)


@SETTINGS
@given(readings, st.sampled_from([6, 24]))
def test_asof_matches_brute_force(spark, rs, lag):
    rows = [reading(s, NOW - timedelta(hours=h), v) for s, h, v in rs]
    s = silver.build_silver(to_bronze(spark, rows), NOW)
    latest = gold.gold_latest(s, seed_dim(spark), lag=f"{lag} hours")
    got = {r.station_reference: (r.latest_value, r.value_24h_ago) for r in latest.collect()}
    expect = {}
    for station in {r[0] for r in rs}:
        pts = sorted((NOW - timedelta(hours=h), v) for st_, h, v in rs if st_ == station)
        last_t, last_v = pts[-1]
        older = [v for t, v in pts if t <= last_t - timedelta(hours=lag)]
        expect[station] = (last_v, older[-1] if older else None)
    assert got == expect


points = st.lists(
    st.tuples(st.integers(0, 120), st.integers(-400, 400).map(lambda x: x / 10.0)),  # 15-min slots back, value
    min_size=1,
    max_size=20,
    unique_by=lambda t: t[0],
)


@SETTINGS
@given(points)
def test_forecast_matches_numpy(spark, ps):
    import numpy as np

    from gaugeflow.operators import forecast

    rows = [reading("4009", NOW - timedelta(minutes=15 * k), v) for k, v in ps]
    series = gold.gold_series(silver.build_silver(to_bronze(spark, rows), NOW), NOW)
    got = sorted((r.k, r.date_time_utc, r.value) for r in forecast.forecast_points(series).collect())
    pts = sorted((NOW - timedelta(minutes=15 * k), v) for k, v in ps)
    expect = []
    if len(pts) >= 4:
        secs = np.array([(t - pts[0][0]).total_seconds() for t, _ in pts])
        recent = secs >= secs.max() - 12 * 3600
        if recent.sum() >= 4:
            slope = np.polyfit(secs[recent], np.array([v for _, v in pts])[recent], 1)[0]
            last_t, last_v = pts[-1]
            expect = [(k, last_t + timedelta(seconds=k * 900), round(last_v + slope * k * 900 * 0.97**k, 3)) for k in range(1, 25)]
    assert [(k, t) for k, t, _ in got] == [(k, t) for k, t, _ in expect]
    for (_, _, g), (_, _, e) in zip(got, expect, strict=True):
        assert abs(g - e) <= 1e-3 + 1e-9  # 3-dp rounding may differ on an exact tie
