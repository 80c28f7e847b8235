"""Time functions. Timestamps are TIMESTAMP_NTZ holding UTC wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.config import ISO_Z_FORMAT, TEXT_TS_FORMAT


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_ntz(text: Column | str) -> Column:
    """Strict cast of ISO text to a naive timestamp (bad text is an error)."""
    return _c(text).cast("timestamp_ntz")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from ``start`` to ``end`` from the exact microsecond gap."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(1e6)


def plus_seconds(ts: Column | str, seconds: Column | int) -> Column:
    secs = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_add("SECOND", secs, _c(ts))


def iso_z(ts: Column | str) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text of a UTC timestamp (seconds precision)."""
    return F.date_format(_c(ts), ISO_Z_FORMAT)


def ts_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text, always with the time part."""
    return F.date_format(_c(ts), TEXT_TS_FORMAT)


def age_minutes(then: Column | str, now: Column | str) -> Column:
    """Whole minutes from ``then`` to ``now``, halves rounded up."""
    return F.floor(elapsed_seconds(then, now) / F.lit(60.0) + F.lit(0.5)).cast("long")


def batch_name(run_ts_text: Column | str) -> Column:
    """``batch_<stamp>`` with ``:`` and ``-`` removed from the run stamp."""
    return F.concat(F.lit("batch_"), F.translate(_c(run_ts_text), ":-", ""))


def hours_before(now: Column | str, hours: int) -> Column:
    """``now - hours`` as ``yyyy-MM-ddTHH:mm:ssZ`` text (a lookback start)."""
    return iso_z(F.timestamp_add("HOUR", F.lit(-int(hours)), _c(now)))
