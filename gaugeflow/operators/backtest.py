"""Trend at every reading, and the forecasts of the past held against what came.

:func:`rolling_trend` fits the least-squares slope over the ``fit_hours`` before each
instant of a group (both ends inclusive), not only before its newest one. Time is
cut into blocks as long as the fit window, so the window of an instant is the head
of its own block and the tail of the block before, from the same offset on.
Each instant is one row of mergeable moments (count, sums and products about its block's
start) and goes to its own block as new and to the next one as old. One
exchange on (group, block) then gives every fit from two running sums, and a
hot group is as many tasks as it has blocks. Rows of one instant are combined
before they move, so a block holds at most the instants that its hours have.

Sums run over one window length only, never over a whole series, so nothing large cancels.

:func:`backtest` asks for each instant which forecast, made ``horizon_hours`` earlier, spoke
of it: an as-of lookup of the trend, projected with the same damping.

Defined cases: rows without a group, time or value take no part; several readings at one
instant share a fit and the largest key gives the value; a fit over fewer than
``min_points`` readings, or over one instant, has no slope; an empty series gives
no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.config import DAMPING, FIT_HOURS, FORECAST_HOURS, MIN_POINTS, STEP_MIN
from gaugeflow.functions.timefns import elapsed_seconds
from gaugeflow.operators.asof import asof_every
from gaugeflow.session import materialize

MOMENTS = ("_instants", "_n", "_sx", "_sy", "_sxx", "_sxy")


def rolling_trend(
    series: DataFrame,
    group: Sequence[str] | str = "station_reference",
    fit_hours: int = FIT_HOURS,
    min_points: int = MIN_POINTS,
    ts: str = "date_time_utc",
    value: str = "value",
    tie: str = "reading_id",
) -> DataFrame:
    """``group…, ts, value, n_recent, slope`` for every instant of a group."""
    group = [group] if isinstance(group, str) else list(group)
    keys = [f"_k{i}" for i in range(len(group))]
    span = int(fit_hours) * 3600 * 1_000_000
    usable = F.col(ts).isNotNull() & F.col(value).isNotNull()
    for c in group:
        usable = usable & F.col(c).isNotNull()
    pts = series.where(usable).select(
        *[F.col(c).alias(k) for c, k in zip(group, keys)], F.col(ts).alias("_at"), F.col(value).cast("double").alias("_y"), F.col(tie).alias("_tie")
    )
    instants = pts.groupBy(*keys, "_at").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_sy"), F.max_by("_y", "_tie").alias("_last")
    )
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("_at"))
    offset = F.pmod(micros, F.lit(span))
    instants = instants.withColumns({"_off": offset, "_block": ((micros - offset) / span).cast("long")})

    # To the block of its own, and to the next one, whose start it precedes.
    sent = instants.withColumn("_old", F.explode(F.array(F.lit(False), F.lit(True))))
    x = (F.col("_off") - F.when(F.col("_old"), F.lit(span)).otherwise(F.lit(0))) / F.lit(1e6)
    sent = sent.withColumns({"_block": F.col("_block") + F.col("_old").cast("long"), "_x": x}).withColumns(
        {
            "_instants": F.lit(1),
            "_sx": F.col("_n") * F.col("_x"),
            "_sxx": F.col("_n") * F.col("_x") * F.col("_x"),
            "_sxy": F.col("_sy") * F.col("_x"),
        }
    )
    block = Window.partitionBy(*keys, "_block")
    head = block.orderBy("_off").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    tail = block.orderBy(F.col("_off").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def over_window(m: str):
        new = F.sum(F.when(~F.col("_old"), F.col(m))).over(head)
        old = F.sum(F.when(F.col("_old"), F.col(m))).over(tail)
        return F.coalesce(new, F.lit(0)) + F.coalesce(old, F.lit(0))

    fits = sent.select("*", *[over_window(m).alias(f"_w{m}") for m in MOMENTS]).where(~F.col("_old"))
    n, sx, sy, sxx, sxy = (F.col(f"_w{m}") for m in MOMENTS[1:])
    slope = (n * sxy - sx * sy) / (n * sxx - sx * sx)
    fitted = (F.col("_w_instants") > 1) & (n >= min_points)
    return fits.select(
        *[F.col(k).alias(c) for c, k in zip(group, keys)],
        F.col("_at").alias(ts),
        F.col("_last").alias(value),
        n.cast("long").alias("n_recent"),
        F.when(fitted, slope).alias("slope"),
    )


def backtest(
    series: DataFrame,
    group: Sequence[str] | str = "station_reference",
    fit_hours: int = FIT_HOURS,
    horizon_hours: int = FORECAST_HOURS,
    slack: str = "1 hours",
    step_min: int = STEP_MIN,
    damp: float = DAMPING,
    min_points: int = MIN_POINTS,
    ts: str = "date_time_utc",
    value: str = "value",
    tie: str = "reading_id",
) -> DataFrame:
    """The trend of every instant with ``made_at, predicted, error``: the forecast of the
    newest instant at least ``horizon_hours`` older (and no more than ``slack`` beyond
    that), projected to this one, and how far the value lies from it. Null where no
    such instant has a slope."""
    group = [group] if isinstance(group, str) else list(group)
    trend = materialize(rolling_trend(series, group, fit_hours, min_points, ts, value, tie), "rolling-trend")
    made = trend.withColumn("_model", F.struct(F.col(ts).alias("at"), F.col(value).alias("last"), F.col("slope")))
    seen = asof_every(made, group, ts, "_model", lag=f"{int(horizon_hours)} hours", out_col="_made", tolerance=slack)
    ds = elapsed_seconds("_made.at", ts)
    projected = F.col("_made.last") + F.col("_made.slope") * ds * F.pow(F.lit(damp), ds / F.lit(step_min * 60.0))
    told = seen.withColumn("predicted", projected)
    return told.select(
        *trend.columns,
        F.when(F.col("predicted").isNotNull(), F.col("_made.at")).alias("made_at"),
        F.round("predicted", 3).alias("predicted"),
        F.round(F.col(value) - F.col("predicted"), 3).alias("error"),
    )


def backtest_summary(tested: DataFrame, group: Sequence[str] | str = "station_reference") -> DataFrame:
    """Per group: instants with a forecast, mean error and mean absolute error."""
    group = [group] if isinstance(group, str) else list(group)
    return tested.groupBy(*group).agg(
        F.count("error").alias("n_tested"),
        F.avg("error").alias("bias"),
        F.avg(F.abs("error")).alias("mean_abs_error"),
    )
