"""Column expressions (scalar functions). All are native Spark expressions:
no Python runs per row."""

from gaugeflow.functions.keys import mint_reading_id, sanitize_reading_id
from gaugeflow.functions.timefns import (
    age_minutes,
    batch_name,
    elapsed_seconds,
    hours_before,
    iso_z,
    plus_seconds,
    to_ntz,
    ts_text,
)
from gaugeflow.functions.values import falsy_coalesce, quality_flag, try_double

__all__ = [
    "age_minutes",
    "batch_name",
    "elapsed_seconds",
    "falsy_coalesce",
    "hours_before",
    "iso_z",
    "mint_reading_id",
    "plus_seconds",
    "quality_flag",
    "sanitize_reading_id",
    "to_ntz",
    "try_double",
    "ts_text",
]
