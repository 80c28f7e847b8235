"""Layers registered as queryable SQL views (published Parquet or live tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYER_VIEWS = {
    "gold_station_latest": "gold_station_latest",
    "gold_series": "gold_series",
    "silver_readings": "silver",
    "bronze": "bronze_window",
}


def register_layers(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_published(spark: SparkSession, root: str, layers: dict[str, str] | None = None) -> None:
    """``CREATE VIEW <name> AS SELECT * FROM parquet.`<folder>/<layer>``` for each
    layer. ``root`` is a publish root, whose pointer names the folder, or a
    folder of layers itself."""
    from gaugeflow.plans.publish import current_version

    root = current_version(spark, root) or root
    for view, layer in (layers or LAYER_VIEWS).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT * FROM parquet.`{root.rstrip('/')}/{layer}`")


def point_lookup(spark: SparkSession, view: str, reading_id: str) -> DataFrame:
    """Bound-parameter lookup by key (pushed to the scan as ``EqualTo``)."""
    return spark.sql(f"SELECT * FROM {view} WHERE reading_id = :rid", args={"rid": reading_id})


#: What a trace returns, as :func:`gaugeflow.operators.trace.trace` does.
TRACE_COLUMNS = (
    "reading_id STRING, date_time_utc TIMESTAMP_NTZ, copies BIGINT, first_ingested_at TIMESTAMP_NTZ, "
    "last_ingested_at TIMESTAMP_NTZ, silver_value DOUBLE, quality_flag STRING, kept_ingested_at TIMESTAMP_NTZ, "
    "gold_value DOUBLE, unit_name STRING"
)

_TRACE_BODY = """
SELECT max(reading_id), max(date_time_utc), count(ingested_at), min(ingested_at), max(ingested_at),
  max(silver_value), max(quality_flag), max(kept_ingested_at), max(gold_value), max(unit_name)
FROM (
  SELECT reading_id, CAST(_ingested_at AS TIMESTAMP_NTZ) AS ingested_at, NULL AS silver_value, NULL AS quality_flag,
    NULL AS kept_ingested_at, NULL AS date_time_utc, NULL AS gold_value, NULL AS unit_name
  FROM {bronze} WHERE reading_id = regexp_replace(rid, '(?i)[^a-f0-9]', '')
  UNION ALL
  SELECT reading_id, NULL, value, quality_flag, ingested_at, NULL, NULL, NULL
  FROM {silver} WHERE reading_id = regexp_replace(rid, '(?i)[^a-f0-9]', '')
  UNION ALL
  SELECT reading_id, NULL, NULL, NULL, NULL, date_time_utc, value, unit_name
  FROM {series} WHERE reading_id = regexp_replace(rid, '(?i)[^a-f0-9]', '')
)
HAVING count(*) > 0
"""


def register_catalog(spark: SparkSession, root: str, database: str = "default", prefix: str = "") -> None:
    """The published layers as views kept in the catalog (they outlive the session where the
    catalog does) and the table function ``<prefix>trace(rid)`` over them, which takes the key
    as pasted (SQL calls it by its bare name, with ``database`` current). Run again after a publish: the views name the folder that was current."""
    from gaugeflow.plans.publish import current_version

    folder = (current_version(spark, root) or root).rstrip("/")
    name = {view: f"`{database}`.`{prefix}{view}`" for view in [*LAYER_VIEWS, "trace"]}
    for view, layer in LAYER_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name[view]} AS SELECT * FROM parquet.`{folder}/{layer}`")
    body = _TRACE_BODY.format(bronze=name["bronze"], silver=name["silver_readings"], series=name["gold_series"])
    spark.sql(f"CREATE OR REPLACE FUNCTION {name['trace']}(rid STRING) RETURNS TABLE ({TRACE_COLUMNS}) RETURN {body}")
