"""Value functions: tolerant numeric cast and the quality flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.config import RANGE_HIGH, RANGE_LOW

# FIXED VALUES — text accepted as a number by the tolerant cast being
# reproduced: optional sign; digit groups joined by single underscores
# (``1_000``) in the integer part, fraction and exponent; ``1.`` and ``.5``;
# an exponent; or inf / infinity / nan in any case; surrounding blanks.
# Anything else (``1d``, ``0x10``, ``1__0``, ``1,5``) is null.
_DIGITS = r"\d+(_\d+)*"
NUMERIC_TEXT = (
    r"(?i)^\s*[+-]?((" + _DIGITS + r"(\.(" + _DIGITS + r")?)?|\.(" + _DIGITS + r"))"
    r"(e[+-]?" + _DIGITS + r")?|inf|infinity|nan)\s*$"
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_double(value: Column | str, data_type: T.DataType | None = None) -> Column:
    """Tolerant cast to double: unparseable text becomes null, never an error."""
    c = _c(value)
    if isinstance(data_type, T.NumericType):
        return c.cast("double")
    text = c.cast("string")
    # Underscores are stripped only when present; Spark's cast already trims
    # blanks and reads inf / infinity / nan in any case, except a signed nan.
    plain = F.when(text.contains("_"), F.regexp_replace(text, "_", "")).otherwise(text)
    cast = plain.try_cast("double")
    signed_nan = F.lower(F.trim(text)).isin("+nan", "-nan")
    parsed = F.when(cast.isNull() & signed_nan, F.lit(float("nan"))).otherwise(cast)
    return F.when(text.rlike(NUMERIC_TEXT), parsed)


def quality_flag(value: Column | str) -> Column:
    """missing (null) first, then out_of_range (exclusive bounds), else ok."""
    v = _c(value)
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when((v < F.lit(RANGE_LOW)) | (v > F.lit(RANGE_HIGH)), F.lit("out_of_range"))
        .otherwise(F.lit("ok"))
    )


def falsy_coalesce(value: Column | str, fallback: Column) -> Column:
    """``value or fallback``: an empty string falls through like a null."""
    v = _c(value)
    return F.coalesce(F.when(v != "", v), fallback)
