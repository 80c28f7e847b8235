"""Fixed values of the pipeline.

FIXED VALUES — these must equal the behaviour being reproduced; they are
stated plainly and together so they can be checked at a glance.
"""

from __future__ import annotations

# --- FIXED VALUES ---------------------------------------------------------
# Quality flag bounds (exclusive): value < -50 or value > 50 is out of range.
RANGE_LOW = -50.0
RANGE_HIGH = 50.0
QUALITY_FLAGS = ("ok", "missing", "out_of_range")

# Accepted parameters (a warn-severity test).
ACCEPTED_PARAMETERS = ("level", "flow", "temperature", "wind", "rainfall")

# Stage filter used by both gold tables.
STAGE_PARAMETER = "level"
STAGE_QUALIFIER = "Stage"
STAGE_FLAG = "ok"

# Windows.
SERIES_WINDOW_DAYS = 30  # gold series, inclusive cutoff
BRONZE_EXPORT_DAYS = 90  # rolling bronze export, inclusive cutoff
ASOF_LAG = "24 hours"  # as-of lookback of the latest table, inclusive

# Forecast shape.
FORECAST_HOURS = 6
FIT_HOURS = 12
STEP_MIN = 15
DAMPING = 0.97
MIN_POINTS = 4
FORECAST_METHOD = "linear trend (last 12h, damped); univariate, rainfall not modelled"

# Freshness.
STALE_MINUTES = 360

# Text of a null in the minted key: the key is built from the Python
# rendering of the two parts, where a missing part prints as "None".
NULL_KEY_TEXT = "None"
KEY_SEPARATOR = "|"

# Timestamp text formats.
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TEXT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

ATTRIBUTION = (
    "this uses Environment Agency flood and river level data from the real-time data API (Beta)"
)

# --------------------------------------------------------------------------

# Stages reported in the run metadata document (own names).
PIPELINE_STAGES = ("ingest", "build", "test", "publish")
