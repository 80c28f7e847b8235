"""Damped linear-trend forecast per group (station or reach).

Per group: points with a value; the fit window is the last ``fit_hours``
before the group's newest point (inclusive); least-squares slope over it
(``regr_slope``); projection ``last + slope * ds * damp**k`` for ``k = 1..n``
steps of ``step_min`` minutes. No forecast when the group has fewer than
``min_points`` points in total or in the fit window, or no defined slope
(all fit points at one instant).

Both passes are aggregates combined map-side. The anchors (one row per group)
are written first, and the aggregate behind the join groups by the key wrapped
in a struct: it then has an exchange of its own, so AQE can split the points
of a hot group in the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.config import DAMPING, FIT_HOURS, FORECAST_HOURS, MIN_POINTS, STEP_MIN
from gaugeflow.functions.timefns import elapsed_seconds
from gaugeflow.session import materialize


def forecast_model(
    series: DataFrame,
    group: Sequence[str] | str = "station_reference",
    fit_hours: int = FIT_HOURS,
    min_points: int = MIN_POINTS,
    ts: str = "date_time_utc",
    value: str = "value",
    tie: str = "reading_id",
) -> DataFrame:
    """One row per group: counts, anchor point, slope and eligibility."""
    group = [group] if isinstance(group, str) else list(group)
    pts = series.where(F.col(value).isNotNull()).select(*group, ts, value, tie)
    anchor = pts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.max(ts).alias("last_at"),
        F.max_by(F.col(value), F.struct(F.col(ts), F.col(tie))).alias("last_value"),
    )
    anchor = materialize(anchor, "forecast-anchor")
    fit = (
        pts.join(anchor.select(*group, "last_at"), group, "inner")
        .where(F.col(ts) >= F.col("last_at") - F.expr(f"INTERVAL {int(fit_hours)} HOURS"))
        .groupBy(F.struct(*group).alias("_group"))
        .agg(
            F.count(F.lit(1)).alias("n_recent"),
            F.regr_slope(F.col(value), elapsed_seconds("last_at", ts)).alias("slope"),
        )
        .select("_group.*", "n_recent", "slope")
    )
    m = anchor.join(fit, group, "left")
    eligible = (F.col("n_points") >= min_points) & (F.coalesce(F.col("n_recent"), F.lit(0)) >= min_points) & F.col(
        "slope"
    ).isNotNull()
    return m.select(
        *group,
        "n_points",
        F.coalesce(F.col("n_recent"), F.lit(0)).cast("long").alias("n_recent"),
        "last_at",
        "last_value",
        "slope",
        eligible.alias("eligible"),
    )


def forecast_points(
    series: DataFrame,
    group: Sequence[str] | str = "station_reference",
    fit_hours: int = FIT_HOURS,
    horizon_hours: int = FORECAST_HOURS,
    step_min: int = STEP_MIN,
    damp: float = DAMPING,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Rows ``(group…, k, date_time_utc, value, kind='forecast')``, value rounded to 3 dp."""
    group = [group] if isinstance(group, str) else list(group)
    steps = int(horizon_hours * 60 / step_min)
    step_s = step_min * 60
    m = forecast_model(series, group, fit_hours, min_points).where("eligible")
    k = F.col("k")
    return m.select(*group, "last_at", "last_value", "slope", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("k")).select(
        *group,
        k.cast("int").alias("k"),
        F.timestamp_add("SECOND", k * step_s, F.col("last_at")).alias("date_time_utc"),
        F.round(F.col("last_value") + F.col("slope") * (k * step_s) * F.pow(F.lit(damp), k), 3).alias("value"),
        F.lit("forecast").alias("kind"),
    )


def series_with_forecast(series: DataFrame, forecast: DataFrame, group: str = "station_reference") -> DataFrame:
    """Observed points followed by the forecast, tagged with ``kind``."""
    obs = series.select(group, "date_time_utc", "value", F.lit("observed").alias("kind"))
    return obs.unionByName(forecast.select(group, "date_time_utc", "value", "kind"))
