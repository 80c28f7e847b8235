"""Trace-key functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeflow.config import KEY_SEPARATOR, NULL_KEY_TEXT


def mint_reading_id(measure: Column | str, date_time: Column | str) -> Column:
    """md5 of ``measure|date_time``; a missing part is spelled ``None``.

    Minted once when a reading lands and carried unchanged afterwards."""
    return F.md5(
        F.concat(
            F.coalesce(F.col(measure) if isinstance(measure, str) else measure, F.lit(NULL_KEY_TEXT)),
            F.lit(KEY_SEPARATOR),
            F.coalesce(F.col(date_time) if isinstance(date_time, str) else date_time, F.lit(NULL_KEY_TEXT)),
        )
    )


def sanitize_reading_id(rid: Column | str) -> Column:
    """Keep hex digits only; an empty result becomes null."""
    c = F.col(rid) if isinstance(rid, str) else rid
    cleaned = F.regexp_replace(c, "(?i)[^a-f0-9]", "")
    return F.when(cleaned == "", F.lit(None).cast("string")).otherwise(cleaned)
