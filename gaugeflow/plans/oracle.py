"""DuckDB SQL oracles, one per catalogue query.

Each statement repeats the reading mapping over the registered ``events`` and
``supplier`` views and then states the query in plain SQL, close to how the
original SQL models express it (correlated subquery for the as-of value,
``row_number`` for dedupe). It is an independent second implementation used
only to check the Spark results.
"""

from __future__ import annotations

from gaugeflow.config import ATTRIBUTION, FORECAST_METHOD

BASE = r"""
WITH ev AS (
  SELECT event_id, ts, user_id, value,
    'user-' || CAST(user_id AS VARCHAR)
      || CASE WHEN user_id % 15 = 0 THEN '-' || strftime(ts, '%Y-%m-%d') ELSE '' END AS measure,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS date_time,
    CASE event_type WHEN 'error' THEN 'flow' WHEN 'signup' THEN 'rainfall' ELSE 'level' END AS parameter,
    CASE WHEN event_id % 10 = 0 THEN 'Downstream Stage' ELSE 'Stage' END AS qualifier,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'n/a'
         ELSE CAST(value AS VARCHAR) END AS value1
  FROM events
),
copies AS (
  SELECT *, value1 AS vtext, ts + INTERVAL 1 HOUR AS ing FROM ev
  UNION ALL SELECT *, CAST(value + 0.01 AS VARCHAR), ts + INTERVAL 4 HOUR FROM ev WHERE event_id % 7 = 0
  UNION ALL SELECT *, value1, ts + INTERVAL 7 HOUR FROM ev WHERE event_id % 21 = 0
),
bronze AS (
  SELECT md5(coalesce(measure, 'None') || '|' || coalesce(date_time, 'None')) AS reading_id,
    measure, CAST(user_id AS VARCHAR) AS station_reference,
    'Station ' || CAST(user_id AS VARCHAR) AS station_label,
    parameter, qualifier, 'm' AS unit_name, date_time, vtext AS value,
    strftime(ing, '%Y-%m-%dT%H:%M:%SZ') AS _ingested_at,
    strftime(ing, '%Y-%m-%dT%H:%M:%SZ') AS _source_batch_id
  FROM copies
),
dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS station_reference, s_name AS station_label,
    'Nation ' || CAST(s_nationkey AS VARCHAR) AS river_name,
    CAST(CASE WHEN s_suppkey % 3 = 0 THEN 25.0 END AS DOUBLE) AS threshold_m,
    CAST(CASE WHEN s_suppkey % 5 <> 0 THEN 40.0 END AS DOUBLE) AS typical_range_high
  FROM supplier
),
typed AS (
  SELECT reading_id, measure, station_reference, station_label, parameter, qualifier, unit_name,
    CAST(date_time AS TIMESTAMP) AS date_time_utc,
    TRY_CAST(value AS DOUBLE) AS value,
    CAST(_ingested_at AS TIMESTAMP) AS ingested_at,
    _source_batch_id AS source_batch_id
  FROM bronze
  WHERE measure IS NOT NULL AND date_time IS NOT NULL
),
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY reading_id
      ORDER BY ingested_at DESC NULLS LAST, source_batch_id DESC NULLS LAST, value DESC NULLS LAST) AS rn
    FROM typed) WHERE rn = 1
),
silver AS (
  SELECT reading_id, measure, station_reference, station_label, parameter, qualifier, unit_name,
    date_time_utc, value,
    CASE WHEN value IS NULL THEN 'missing'
         WHEN value < -50 OR value > 50 THEN 'out_of_range'
         ELSE 'ok' END AS quality_flag,
    ingested_at, source_batch_id
  FROM kept
),
stage AS (
  SELECT * FROM silver WHERE parameter = 'level' AND qualifier = 'Stage' AND quality_flag = 'ok'
),
series AS (
  SELECT reading_id, station_reference, station_label, parameter, qualifier, date_time_utc, value, unit_name
  FROM stage
  WHERE date_time_utc >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY
),
latest_rows AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY measure ORDER BY date_time_utc DESC, reading_id DESC) AS rn
    FROM stage) WHERE rn = 1
),
latest AS (
  SELECT l.reading_id, l.station_reference, l.station_label, l.measure, l.unit_name,
    l.date_time_utc AS latest_at, l.value AS latest_value,
    (SELECT s2.value FROM stage s2
      WHERE s2.measure = l.measure AND s2.date_time_utc <= l.date_time_utc - INTERVAL 24 HOUR
      ORDER BY s2.date_time_utc DESC, s2.reading_id DESC LIMIT 1) AS value_24h_ago,
    coalesce(d.threshold_m, d.typical_range_high) AS threshold
  FROM latest_rows l LEFT JOIN dim d ON d.station_reference = l.station_reference
),
gold_latest AS (
  SELECT reading_id, station_reference, station_label, measure, unit_name, latest_at, latest_value,
    value_24h_ago, round(latest_value - value_24h_ago, 3) AS change_24h, threshold,
    latest_value > threshold AS above_threshold
  FROM latest
)
"""

# Data-quality results: the eleven tests.
DQ = r""",
dq AS (
  SELECT 'test.not_null_silver_reading_id' AS test_id, 'silver' AS model, 'reading_id' AS column_name,
         'not_null' AS test_type, 'error' AS severity, CAST(count_if(reading_id IS NULL) AS BIGINT) AS failures FROM silver
  UNION ALL SELECT 'test.unique_silver_reading_id', 'silver', 'reading_id', 'unique', 'error',
         CAST((SELECT count(*) FROM (SELECT reading_id FROM silver WHERE reading_id IS NOT NULL
               GROUP BY reading_id HAVING count(*) > 1)) AS BIGINT)
  UNION ALL SELECT 'test.not_null_silver_date_time_utc', 'silver', 'date_time_utc', 'not_null', 'error',
         CAST(count_if(date_time_utc IS NULL) AS BIGINT) FROM silver
  UNION ALL SELECT 'test.accepted_values_silver_parameter', 'silver', 'parameter', 'accepted_values', 'warn',
         CAST(count(DISTINCT CASE WHEN parameter NOT IN ('level','flow','temperature','wind','rainfall') THEN parameter END) AS BIGINT) FROM silver
  UNION ALL SELECT 'test.accepted_values_silver_quality_flag', 'silver', 'quality_flag', 'accepted_values', 'error',
         CAST(count(DISTINCT CASE WHEN quality_flag NOT IN ('ok','missing','out_of_range') THEN quality_flag END) AS BIGINT) FROM silver
  UNION ALL SELECT 'test.relationships_silver_station_reference', 'silver', 'station_reference', 'relationships', 'warn',
         CAST(count(*) AS BIGINT) FROM silver s
         WHERE s.station_reference IS NOT NULL
           AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.station_reference = s.station_reference)
  UNION ALL SELECT 'test.not_null_gold_series_reading_id', 'gold_series', 'reading_id', 'not_null', 'error',
         CAST(count_if(reading_id IS NULL) AS BIGINT) FROM series
  UNION ALL SELECT 'test.not_null_gold_series_value', 'gold_series', 'value', 'not_null', 'error',
         CAST(count_if(value IS NULL) AS BIGINT) FROM series
  UNION ALL SELECT 'test.not_null_gold_station_latest_station_reference', 'gold_station_latest', 'station_reference',
         'not_null', 'error', CAST(count_if(station_reference IS NULL) AS BIGINT) FROM gold_latest
  UNION ALL SELECT 'test.unique_gold_station_latest_station_reference', 'gold_station_latest', 'station_reference',
         'unique', 'error',
         CAST((SELECT count(*) FROM (SELECT station_reference FROM gold_latest WHERE station_reference IS NOT NULL
               GROUP BY station_reference HAVING count(*) > 1)) AS BIGINT)
  UNION ALL SELECT 'test.not_null_gold_station_latest_latest_value', 'gold_station_latest', 'latest_value',
         'not_null', 'error', CAST(count_if(latest_value IS NULL) AS BIGINT) FROM gold_latest
),
dq_results AS (
  SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM dq
),
dq_summary AS (
  SELECT CAST(count_if(status = 'pass') AS BIGINT) AS tests_passed, CAST(count(*) AS BIGINT) AS tests_total,
    CAST(count_if(status = 'warn') AS BIGINT) AS tests_warned, CAST(count_if(status = 'fail') AS BIGINT) AS tests_failed,
    count_if(status = 'fail') = 0 AS publishable
  FROM dq_results
)
"""

_FORECAST = r""",
pts AS (SELECT @GROUP@ AS reach, date_time_utc, value, reading_id
        FROM series WHERE value IS NOT NULL),
anchor AS (
  SELECT reach, count(*) AS n_points, max(date_time_utc) AS last_at,
    arg_max(value, (date_time_utc, reading_id)) AS last_value
  FROM pts GROUP BY reach
),
fit AS (
  SELECT p.reach, count(*) AS n_recent,
    regr_slope(p.value, (epoch_us(p.date_time_utc) - epoch_us(a.last_at)) / 1e6) AS slope
  FROM pts p JOIN anchor a ON p.reach = a.reach
  WHERE p.date_time_utc >= a.last_at - INTERVAL @HOURS@ HOUR
  GROUP BY p.reach
),
model AS (
  SELECT a.*, coalesce(f.n_recent, 0) AS n_recent, f.slope,
    a.n_points >= 4 AND coalesce(f.n_recent, 0) >= 4 AND f.slope IS NOT NULL AS eligible
  FROM anchor a LEFT JOIN fit f ON a.reach = f.reach
),
fc AS (
  SELECT reach, CAST(k AS INTEGER) AS k,
    last_at + to_seconds(CAST(k * 900 AS BIGINT)) AS date_time_utc,
    round(last_value + slope * (k * 900) * pow(0.97, k), 3) AS value,
    'forecast' AS kind
  FROM model, generate_series(1, 24) AS g(k)
  WHERE eligible
)
"""


def _forecast(group: str, hours: int = 12) -> str:
    return _FORECAST.replace("@GROUP@", group).replace("@HOURS@", str(hours))


FORECAST = _forecast("CAST(CAST(station_reference AS BIGINT) % 4 AS VARCHAR)")
FORECAST_BY_STATION = _forecast("station_reference")

_SQL: dict[str, str] = {}


def _q(name: str, body: str, extra: str = "") -> None:
    _SQL[name] = BASE + extra + body


_q("mint_reading_id", "SELECT DISTINCT measure, date_time, reading_id FROM bronze")
_q(
    "bronze_copies",
    """SELECT reading_id, count(*) AS copies, min(CAST(_ingested_at AS TIMESTAMP)) AS first_ingested_at,
       max(CAST(_ingested_at AS TIMESTAMP)) AS last_ingested_at FROM bronze GROUP BY reading_id""",
)
_q("silver_readings", "SELECT * FROM silver")
_q("silver_flag_counts", "SELECT quality_flag, count(*) AS n FROM silver GROUP BY quality_flag")
DEDUPE = "SELECT reading_id, measure, date_time_utc, value, ingested_at, source_batch_id FROM kept"
_q("dedupe_keep_latest_window", DEDUPE)
_q("dedupe_keep_latest_agg", DEDUPE)
_q(
    "null_key_rows_dropped",
    """SELECT count(*) AS bronze_rows,
       count_if(measure IS NOT NULL AND date_time IS NOT NULL) AS kept_rows,
       count_if(NOT (measure IS NOT NULL AND date_time IS NOT NULL)) AS dropped_rows FROM bronze""",
)
_q(
    "try_cast_values",
    "SELECT reading_id, CAST(_ingested_at AS TIMESTAMP) AS ingested_at, TRY_CAST(value AS DOUBLE) AS value FROM bronze",
)
_q("gold_series_30d", "SELECT * FROM series")
_q("gold_station_latest", "SELECT * FROM gold_latest")
for lag, name in (("24", "asof_24h"), ("6", "asof_6h")):
    _q(
        name,
        f"""SELECT l.measure, l.date_time_utc AS latest_at,
       (SELECT s2.value FROM stage s2
         WHERE s2.measure = l.measure AND s2.date_time_utc <= l.date_time_utc - INTERVAL {lag} HOUR
         ORDER BY s2.date_time_utc DESC, s2.reading_id DESC LIMIT 1) AS value_lag
     FROM latest_rows l""",
    )
_q("threshold_flags", "SELECT station_reference, measure, latest_value, threshold, above_threshold FROM gold_latest")
_q(
    "above_threshold_count",
    "SELECT count(*) AS n_stations, count_if(above_threshold) AS n_above FROM gold_latest",
)
_q(
    "headline_ordered",
    """SELECT station_reference, station_label, latest_value, change_24h, above_threshold FROM gold_latest
       ORDER BY above_threshold DESC NULLS LAST, station_reference, latest_value DESC""",
)
_q(
    "bronze_window_90d",
    """SELECT reading_id, measure, date_time, TRY_CAST(value AS DOUBLE) AS value, _ingested_at FROM bronze
       WHERE CAST(date_time AS TIMESTAMP) >= TIMESTAMP '2024-04-10 00:00:00' - INTERVAL 90 DAY""",
)
_q(
    "semi_silver_in_gold",
    """SELECT reading_id, value, quality_flag, ingested_at FROM silver
       WHERE reading_id IN (SELECT reading_id FROM series)""",
)
_q(
    "semi_bronze_in_gold",
    """SELECT reading_id, TRY_CAST(value AS DOUBLE) AS value, CAST(_ingested_at AS TIMESTAMP) AS ingested_at,
       _source_batch_id AS source_batch_id FROM bronze WHERE reading_id IN (SELECT reading_id FROM series)""",
)
LINEAGE_FLAT = """SELECT g.reading_id, g.station_reference, g.station_label, g.date_time_utc,
       CAST(coalesce(b.copies, 0) AS BIGINT) AS copies, b.first_ingested_at, b.last_ingested_at,
       s.value AS silver_value, s.quality_flag, s.ingested_at AS kept_ingested_at,
       g.value AS gold_value, g.unit_name
     FROM series g
     LEFT JOIN (SELECT reading_id, count(*) AS copies, min(CAST(_ingested_at AS TIMESTAMP)) AS first_ingested_at,
                  max(CAST(_ingested_at AS TIMESTAMP)) AS last_ingested_at
                FROM bronze WHERE reading_id IN (SELECT reading_id FROM series) GROUP BY reading_id) b
       ON b.reading_id = g.reading_id
     LEFT JOIN silver s ON s.reading_id = g.reading_id"""
_q("lineage_flat", LINEAGE_FLAT)
_q(
    "trace_one",
    """, target AS (
       SELECT reading_id FROM bronze WHERE reading_id IN (SELECT reading_id FROM series)
       GROUP BY reading_id ORDER BY count(*) DESC, reading_id ASC LIMIT 1
     ), lf AS (""" + LINEAGE_FLAT + """)
     SELECT reading_id, date_time_utc, copies, first_ingested_at, last_ingested_at, silver_value, quality_flag,
       kept_ingested_at, gold_value, unit_name
     FROM lf WHERE reading_id IN (SELECT reading_id FROM target)""",
)
_q("forecast_points", "SELECT reach, k, date_time_utc, value, kind FROM fc", FORECAST)
_q(
    "forecast_points_by_station",
    "SELECT reach AS station_reference, k, date_time_utc, value, kind FROM fc",
    FORECAST_BY_STATION,
)
_q(
    "series_with_forecast",
    """, both_ AS (
       SELECT reach, date_time_utc, value, reading_id, false AS is_fc FROM pts
       UNION ALL SELECT reach, date_time_utc, value, NULL, true FROM fc)
     SELECT reach, min(date_time_utc) AS first_at, max(date_time_utc) AS last_at,
       min(value) AS min_value, max(value) AS max_value,
       arg_max(value, (date_time_utc, reading_id)) FILTER (WHERE NOT is_fc) AS anchor_value,
       max(date_time_utc) FILTER (WHERE NOT is_fc) AS anchor_at,
       count_if(NOT is_fc) AS n_observed, count_if(is_fc) AS n_forecast
     FROM both_ GROUP BY reach""",
    FORECAST,
)
_q(
    "forecast_guard",
    """, sp AS (SELECT station_reference, date_time_utc, value FROM series WHERE value IS NOT NULL),
     sa AS (SELECT station_reference, count(*) AS n_points, max(date_time_utc) AS last_at FROM sp GROUP BY 1),
     sf AS (SELECT p.station_reference, count(*) AS n_recent,
              regr_slope(p.value, (epoch_us(p.date_time_utc) - epoch_us(a.last_at)) / 1e6) AS slope
            FROM sp p JOIN sa a ON p.station_reference = a.station_reference
            WHERE p.date_time_utc >= a.last_at - INTERVAL 12 HOUR GROUP BY 1)
     SELECT a.station_reference, a.n_points, CAST(coalesce(f.n_recent, 0) AS BIGINT) AS n_recent,
       a.n_points >= 4 AND coalesce(f.n_recent, 0) >= 4 AND f.slope IS NOT NULL AS eligible
     FROM sa a LEFT JOIN sf f ON a.station_reference = f.station_reference""",
)
EXTENT = """SELECT station_reference, min(date_time_utc) AS first_at, max(date_time_utc) AS last_at,
       min(value) AS min_value, max(value) AS max_value,
       arg_max(value, (date_time_utc, reading_id)) AS last_value, count(*) AS n_points
     FROM series GROUP BY station_reference"""
_q("series_extent", EXTENT)
_q(
    "slider_bounds",
    """, ext AS (""" + EXTENT + """),
     th AS (SELECT station_reference, max(threshold) AS threshold FROM gold_latest GROUP BY 1),
     j AS (SELECT e.*, coalesce(t.threshold, e.max_value) AS th,
             CAST(floor(e.min_value * 10) AS DOUBLE) / 10 AS lo FROM ext e LEFT JOIN th t USING (station_reference)),
     k AS (SELECT *, greatest(CAST(ceil(max_value * 10) AS DOUBLE) / 10, th) AS hi FROM j)
     SELECT station_reference, CAST(lo AS DOUBLE) AS slider_min, CAST(hi AS DOUBLE) AS slider_max,
       CAST(least(greatest(th, lo), hi) AS DOUBLE) AS slider_value FROM k""",
)
_q(
    "reflag_threshold",
    """SELECT station_reference, count_if(value > 30.0) AS flagged, count(*) AS total
       FROM series GROUP BY station_reference""",
)
_q(
    "primary_series",
    """SELECT * FROM series WHERE station_reference = coalesce(
         (SELECT max(station_reference) FROM series WHERE station_reference = '7'),
         (SELECT min(station_reference) FROM series))""",
)
_q("dq_results", "SELECT * FROM dq_results", DQ)
_q("dq_summary", "SELECT * FROM dq_summary", DQ)
_q(
    "orphan_stations",
    """SELECT station_reference, count(*) AS silver_rows FROM silver s
       WHERE station_reference IS NOT NULL
         AND NOT EXISTS (SELECT 1 FROM dim d WHERE d.station_reference = s.station_reference)
       GROUP BY station_reference""",
)
_q(
    "station_grain_conflicts",
    """SELECT station_reference, count(*) AS n_measures FROM gold_latest GROUP BY station_reference
       HAVING count(*) > 1""",
)
_q(
    "rows_per_day",
    "SELECT CAST(CAST(date_time AS TIMESTAMP) AS DATE) AS dt, count(*) AS rows FROM bronze GROUP BY 1",
)
_q(
    "run_metadata",
    """SELECT (SELECT max(CAST(_ingested_at AS TIMESTAMP)) FROM bronze) AS last_run_utc,
       (SELECT count(*) FROM bronze WHERE CAST(_ingested_at AS TIMESTAMP) = (SELECT max(CAST(_ingested_at AS TIMESTAMP)) FROM bronze)) AS rows_ingested,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM gold_latest) AS stations,
       (SELECT count_if(above_threshold) FROM gold_latest) AS above_threshold,
       (SELECT tests_passed FROM dq_summary) AS tests_passed,
       (SELECT tests_total FROM dq_summary) AS tests_total,
       CASE WHEN (SELECT publishable FROM dq_summary) THEN 'ok' ELSE 'failed' END AS status""",
    DQ,
)
_q(
    "run_health",
    """, rm AS (SELECT (SELECT max(CAST(_ingested_at AS TIMESTAMP)) FROM bronze) AS last_run_utc,
       (SELECT count(*) FROM bronze WHERE CAST(_ingested_at AS TIMESTAMP) = (SELECT max(CAST(_ingested_at AS TIMESTAMP)) FROM bronze)) AS rows_ingested,
       (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM gold_latest) AS stations,
       (SELECT count_if(above_threshold) FROM gold_latest) AS above_threshold,
       (SELECT tests_passed FROM dq_summary) AS tests_passed,
       (SELECT tests_total FROM dq_summary) AS tests_total,
       CASE WHEN (SELECT publishable FROM dq_summary) THEN 'ok' ELSE 'failed' END AS status)
     SELECT rm.*,
       CAST(floor((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_run_utc)) / 1e6 / 60.0 + 0.5) AS BIGINT)
         AS age_minutes,
       coalesce(floor((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_run_utc)) / 1e6 / 60.0 + 0.5) > 360,
         false) AS stale,
       CASE WHEN coalesce(floor((epoch_us(TIMESTAMP '2024-01-31 12:00:00') - epoch_us(last_run_utc)) / 1e6 / 60.0
         + 0.5) > 360, false) THEN 'stale' ELSE 'last-known-good' END AS health_status
     FROM rm""",
    DQ,
)
_q(
    "freshness",
    """, f AS (SELECT station_reference, max(date_time_utc) AS last_at FROM silver GROUP BY 1)
     SELECT station_reference, last_at,
       CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_at)) / 1e6 / 60.0 + 0.5) AS BIGINT) AS age_minutes,
       floor((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_at)) / 1e6 / 60.0 + 0.5) > 360 AS stale
     FROM f""",
)
_q(
    "newest_n_per_station",
    """SELECT station_reference, reading_id, date_time_utc, rank FROM (
       SELECT station_reference, reading_id, date_time_utc,
         CAST(row_number() OVER (PARTITION BY station_reference
              ORDER BY date_time_utc DESC NULLS LAST, reading_id DESC NULLS LAST) AS INTEGER) AS rank
       FROM silver) WHERE rank <= 10""",
)
_q(
    "lookback_since",
    """SELECT reading_id, station_reference, date_time_utc, value FROM silver
       WHERE date_time_utc > CAST('2024-01-29T18:00:00Z' AS TIMESTAMP)""",
)
_q(
    "flatten_payload",
    """, fp AS (
       SELECT 'user-' || CAST(user_id AS VARCHAR)
           || CASE WHEN user_id % 15 = 0 THEN '-' || strftime(ts, '%Y-%m-%d') ELSE '' END AS measure,
         CAST(user_id AS VARCHAR) AS station_reference,
         CASE WHEN event_id % 3 = 0 OR event_id % 11 = 0 THEN NULL ELSE 'Station ' || CAST(user_id AS VARCHAR) END
           AS station_label,
         CASE WHEN event_id % 3 = 0 THEN NULL
              ELSE CASE event_type WHEN 'error' THEN 'flow' WHEN 'signup' THEN 'rainfall' ELSE 'level' END END
           AS parameter,
         CASE WHEN event_id % 3 = 0 THEN NULL
              WHEN event_id % 10 = 0 THEN 'Downstream Stage' ELSE 'Stage' END AS qualifier,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'm' END AS unit_name,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS date_time,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value
       FROM events)
     SELECT md5(coalesce(measure, 'None') || '|' || coalesce(date_time, 'None')) AS reading_id, * FROM fp""",
)
_q(
    "discover_stations",
    """SELECT CAST(s_suppkey AS VARCHAR) AS station_reference, s_name AS station_label,
       'Nation ' || CAST(s_nationkey AS VARCHAR) AS river_name,
       'Town ' || CAST(s_nationkey % 7 AS VARCHAR) AS town,
       s_acctbal / 100.0 AS lat, CAST(s_nationkey AS DOUBLE) / 10.0 AS long, 'Active' AS status,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS DOUBLE) / 10.0 END
         AS typical_range_high
     FROM supplier WHERE contains(s_name, '00000001')""",
)
_q(
    "drifted_scan",
    "SELECT reading_id, CAST(_ingested_at AS TIMESTAMP) AS ingested_at, TRY_CAST(value AS DOUBLE) AS value FROM bronze",
)
_q("stream_silver", "SELECT * FROM silver")
_q(
    "stream_latest",
    """SELECT measure, reading_id, station_reference, date_time_utc AS latest_at, value AS latest_value
       FROM latest_rows""",
)
_q(
    "landed_bronze_days",
    """SELECT CAST(CAST(date_time AS TIMESTAMP) AS DATE) AS dt,
       CASE WHEN substr(reading_id, 1, 1) < '8' THEN 'batch_20240201T000000Z' ELSE 'batch_20240201T030000Z' END
         AS batch,
       count(*) AS rows
     FROM bronze GROUP BY 1, 2""",
)
_SQL["stream_bronze"] = _SQL["flatten_payload"]
_q(
    "landed_run_date",
    "SELECT DATE '2024-02-01' AS dt, 'batch_20240201T000000Z' AS batch, count(*) AS rows FROM bronze",
)
_q("lineage_lookup", LINEAGE_FLAT)
_q("stream_gold_latest", "SELECT * FROM gold_latest")
_q(
    "ingest_run",
    """, fr AS (
       SELECT 'user-' || CAST(user_id AS VARCHAR)
           || CASE WHEN user_id % 15 = 0 THEN '-' || strftime(ts, '%Y-%m-%d') ELSE '' END AS measure,
         CAST(user_id AS VARCHAR) AS station_reference,
         CASE WHEN event_id % 101 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS date_time,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value
       FROM events)
     SELECT md5(coalesce(measure, 'None') || '|' || coalesce(date_time, 'None')) AS reading_id,
       station_reference, date_time, value,
       '2024-01-30T00:00:00Z' AS _ingested_at, 'batch_20240130T000000Z' AS batch
     FROM fr
     WHERE station_reference IN (SELECT station_reference FROM dim)
       AND (date_time IS NULL OR CAST(date_time AS TIMESTAMP) > TIMESTAMP '2024-01-28 00:00:00')""",
)

STATIONS = _SQL["discover_stations"]
_SQL["payload_files"] = STATIONS[: STATIONS.index("WHERE contains(s_name")]
_q("dim_csv", "SELECT * FROM dim")
_SQL["ingest_empty"] = """SELECT '2024-01-30T00:00:00Z' AS last_ingest_utc, '2024-01-28T00:00:00Z' AS since,
       count_if(CAST(user_id AS VARCHAR) = 'no such station') AS rows_ingested, CAST(1 AS BIGINT) AS stations FROM events"""
_SQL["lineage_run_date"] = _SQL["lineage_flat"]
_SQL["bronze_window_run_date"] = _SQL["bronze_window_90d"]
_q(
    "asof_every_reading",
    """SELECT s.reading_id, s.measure, s.date_time_utc, s.value, v.value AS value_24h_ago, round(s.value - v.value, 3) AS change_24h
     FROM (SELECT *, date_time_utc - INTERVAL 24 HOUR AS bound FROM stage) s
     ASOF LEFT JOIN (SELECT measure, date_time_utc, arg_max(value, reading_id) AS value FROM stage GROUP BY measure, date_time_utc) v
       ON s.measure = v.measure AND s.bound >= v.date_time_utc""",
)
_SQL["lineage_records"] = _SQL["semi_bronze_in_gold"]
_q(
    "lineage_documents",
    ", lf AS (" + LINEAGE_FLAT + """)
     SELECT reading_id, station_reference, strftime(date_time_utc, '%Y-%m-%d %H:%M:%S') AS date_time_utc, copies,
       strftime(first_ingested_at, '%Y-%m-%d %H:%M:%S') AS first_ingested_at,
       strftime(last_ingested_at, '%Y-%m-%d %H:%M:%S') AS last_ingested_at,
       silver_value, quality_flag, strftime(kept_ingested_at, '%Y-%m-%d %H:%M:%S') AS kept_ingested_at,
       gold_value, unit_name
     FROM lf""",
)
_SQL["trace_by_id"] = _SQL["trace_one"]
_q(
    "trace_records",
    """, target AS (
       SELECT reading_id FROM bronze WHERE reading_id IN (SELECT reading_id FROM series)
       GROUP BY reading_id ORDER BY count(*) DESC, reading_id ASC LIMIT 1)
     SELECT reading_id, TRY_CAST(value AS DOUBLE) AS value, CAST(_ingested_at AS TIMESTAMP) AS ingested_at,
       _source_batch_id AS source_batch_id FROM bronze WHERE reading_id IN (SELECT reading_id FROM target)""",
)
_q(
    "series_stored_order",
    """SELECT reading_id, station_reference, date_time_utc,
       row_number() OVER (ORDER BY station_reference, date_time_utc, reading_id) AS position FROM series""",
)
_q(
    "forecast_station_month",
    "SELECT reach AS station_reference, k, date_time_utc, value, kind FROM fc",
    _forecast("station_reference", 720),
)
_SQL["dq_offending_values"] = _SQL["dq_results"].replace("'error' THEN 'flow'", "'error' THEN 'discharge'")
#: Bronze in which a station has one measure, so every check passes.
_MEASURE = "|| CASE WHEN user_id % 15 = 0 THEN '-' || strftime(ts, '%Y-%m-%d') ELSE '' END AS measure"
_SQL["published_latest"] = _SQL["gold_station_latest"].replace(_MEASURE, "AS measure")
_SQL["published_after_failed_run"] = _SQL["published_latest"]

_q(
    "series_by_time",
    "SELECT reading_id, date_time_utc, row_number() OVER (ORDER BY date_time_utc NULLS LAST, reading_id NULLS LAST) AS position FROM series",
)
_q(
    "lineage_record_order",
    """SELECT reading_id, CAST(_ingested_at AS TIMESTAMP) AS ingested_at,
       row_number() OVER (ORDER BY reading_id, CAST(_ingested_at AS TIMESTAMP)) AS position
     FROM bronze WHERE reading_id IN (SELECT reading_id FROM series)""",
)
_SQL["trace_record_order"] = f"""SELECT *, row_number() OVER (ORDER BY ingested_at, source_batch_id) AS position FROM ({_SQL["trace_records"]})"""
_ONE_MEASURE = BASE.replace(_MEASURE, "AS measure")
_SQL["headline_rank"] = _ONE_MEASURE + """SELECT station_reference, above_threshold,
       row_number() OVER (ORDER BY above_threshold DESC NULLS LAST, station_reference NULLS LAST, latest_value DESC) AS position FROM gold_latest"""
_SQL["run_document"] = _ONE_MEASURE + DQ + f"""SELECT (SELECT count(*) FROM silver) AS silver_rows,
       (SELECT count(*) FROM gold_latest) AS stations, (SELECT count_if(above_threshold) FROM gold_latest)::BIGINT AS above_threshold,
       tests_passed, tests_total, 'ingest:ok,build:ok,test:ok,publish:ok' AS stages, 'ok' AS status, '{ATTRIBUTION}' AS attribution
     FROM dq_summary"""
_SQL["layer_views"] = _ONE_MEASURE + """SELECT 'gold_station_latest' AS view, count(*) AS rows, count(DISTINCT reading_id) AS keys FROM gold_latest
     UNION ALL SELECT 'gold_series', count(*), count(DISTINCT reading_id) FROM series
     UNION ALL SELECT 'silver_readings', count(*), count(DISTINCT reading_id) FROM silver
     UNION ALL SELECT 'bronze', count(*), count(DISTINCT reading_id) FROM bronze
       WHERE CAST(date_time AS TIMESTAMP) >= TIMESTAMP '2024-04-10 00:00:00' - INTERVAL 90 DAY"""
_SQL["heartbeat"] = f"""SELECT '2024-01-30T00:00:00Z' AS last_run_utc, count(*) AS rows, CAST(1440 AS BIGINT) AS age_minutes, true AS stale,
       'stale' AS health_status FROM ({_SQL["ingest_run"]})"""
_q("test_stats", "SELECT tests_passed, tests_total FROM dq_summary", DQ)
_q(
    "forecast_backtest",
    """, pts AS (SELECT CAST(CAST(station_reference AS BIGINT) % 4 AS VARCHAR) AS reach, date_time_utc, value, reading_id FROM series),
     instants AS (SELECT reach, date_time_utc, arg_max(value, reading_id) AS value FROM pts GROUP BY reach, date_time_utc),
     trend AS (
       SELECT i.reach, i.date_time_utc, i.value, count(*) AS n_recent,
         CASE WHEN count(*) >= 4 AND count(DISTINCT p.date_time_utc) > 1
              THEN regr_slope(p.value, (epoch_us(p.date_time_utc) - epoch_us(i.date_time_utc)) / 1e6) END AS slope
       FROM instants i JOIN pts p ON p.reach = i.reach AND p.date_time_utc <= i.date_time_utc
         AND p.date_time_utc >= i.date_time_utc - INTERVAL 12 HOUR
       GROUP BY i.reach, i.date_time_utc, i.value),
     told AS (
       SELECT t.*, m.date_time_utc AS made, (epoch_us(t.date_time_utc) - epoch_us(m.date_time_utc)) / 1e6 AS ds,
         m.value + m.slope * ds * pow(0.97, ds / 900) AS said
       FROM (SELECT *, date_time_utc - INTERVAL 6 HOUR AS bound FROM trend) t
       ASOF LEFT JOIN trend m ON t.reach = m.reach AND t.bound >= m.date_time_utc),
     near AS (SELECT *, made >= bound - INTERVAL 1 HOUR AND said IS NOT NULL AS ok FROM told)
     SELECT reach, date_time_utc, value, n_recent, round(slope, 9) AS slope, CASE WHEN ok THEN made END AS made_at,
       CASE WHEN ok THEN round(said, 3) END AS predicted, CASE WHEN ok THEN round(value - said, 3) END AS error FROM near""",
)
_q(
    "dashboard_documents",
    f""", placed AS (
       SELECT *, row_number() OVER (PARTITION BY station_reference ORDER BY date_time_utc, reading_id) - 1 AS position,
         CAST(ceil(count(*) OVER (PARTITION BY station_reference) / 5) AS INTEGER) AS chunks FROM series)
     SELECT station_reference, CAST(position // 5 AS INTEGER) AS chunk, chunks, '{FORECAST_METHOD}' AS forecast_method, 'observed' AS kind,
       position, strftime(date_time_utc, '%Y-%m-%d %H:%M:%S') AS date_time_utc, value, reading_id FROM placed
     UNION ALL
     SELECT f.reach, 0, p.chunks, '{FORECAST_METHOD}', f.kind, f.k - 1, strftime(f.date_time_utc, '%Y-%m-%d %H:%M:%S'), f.value, NULL
     FROM fc f JOIN placed p ON p.station_reference = f.reach AND p.position = 0""",
    _forecast("station_reference", 720),
)
_SQL["lineage_bucketed"] = _SQL["lineage_flat"]
_SQL["trace_sql"] = _SQL["trace_one"].replace(_MEASURE, "AS measure")


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
