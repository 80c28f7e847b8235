"""Declarative data-quality tests and the publish gate.

A check is a small spec; :func:`run_checks` turns a list of specs into one
DataFrame of results ``(test_id, model, column_name, test_type, severity,
failures, status)``. All ``not_null`` and ``accepted_values`` checks of a table
come from ONE pass over it: rows are grouped by their offending values (nulls
where a value is accepted, so the groups are as few as the offending
combinations), and a second aggregate over those groups sums the nulls and counts the
distinct offending values. ``unique`` is a grouped count
(combined map-side); ``relationships`` is an anti join on non-null keys.
Failures follow the usual conventions: rows for ``not_null`` and
``relationships``, offending keys for ``unique``, offending distinct values
for ``accepted_values`` (a null is accepted).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.config import ACCEPTED_PARAMETERS, QUALITY_FLAGS


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str  # not_null | unique | accepted_values | relationships
    severity: str = "error"
    values: tuple = field(default=())
    to_model: str | None = None
    to_column: str | None = None

    @property
    def test_id(self) -> str:
        return f"test.{self.kind}_{self.model}_{self.column}"


# FIXED VALUES: the eleven checks of the pipeline, in declaration order.
DEFAULT_CHECKS = (
    Check("silver", "reading_id", "not_null"),
    Check("silver", "reading_id", "unique"),
    Check("silver", "date_time_utc", "not_null"),
    Check("silver", "parameter", "accepted_values", "warn", ACCEPTED_PARAMETERS),
    Check("silver", "quality_flag", "accepted_values", "error", QUALITY_FLAGS),
    Check("silver", "station_reference", "relationships", "warn", (), "dim_stations", "station_reference"),
    Check("gold_series", "reading_id", "not_null"),
    Check("gold_series", "value", "not_null"),
    Check("gold_station_latest", "station_reference", "not_null"),
    Check("gold_station_latest", "station_reference", "unique"),
    Check("gold_station_latest", "latest_value", "not_null"),
)


def _single_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row with ``f0, f1, ...``: the failures of the checks, in order."""
    offending, nulls, totals = [], [], []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.kind == "accepted_values":
            offending.append(F.when(~col.isin(*c.values), col).alias(f"v{i}"))
            totals.append(F.count_distinct(f"v{i}").alias(f"f{i}"))
        else:
            nulls.append(F.count_if(col.isNull()).alias(f"n{i}"))
            totals.append(F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"f{i}"))
    groups = df.groupBy(*offending).agg(*(nulls or [F.count(F.lit(1)).alias("n")]))
    return groups.agg(*totals)


def _result_row(spark_df: DataFrame, c: Check, failures: Column) -> DataFrame:
    return spark_df.select(_result_struct(c, failures).alias("r")).select("r.*")


def _result_struct(c: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(c.test_id).alias("test_id"),
        F.lit(c.model).alias("model"),
        F.lit(c.column).alias("column_name"),
        F.lit(c.kind).alias("test_type"),
        F.lit(c.severity).alias("severity"),
        failures.cast("long").alias("failures"),
    )


def run_checks(tables: dict[str, DataFrame], checks: tuple[Check, ...] = DEFAULT_CHECKS) -> DataFrame:
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    for model, cs in by_model.items():
        df = tables[model]
        single = [c for c in cs if c.kind in ("not_null", "accepted_values")]
        if single:
            # The pass's one row is unpivoted into result rows.
            wide = _single_pass(df, single)
            rows = F.array(*[_result_struct(c, F.col(f"f{i}")) for i, c in enumerate(single)])
            parts.append(wide.select(F.explode(rows).alias("r")).select("r.*"))
        for c in cs:
            if c.kind == "unique":
                dup = (
                    df.where(F.col(c.column).isNotNull())
                    .groupBy(c.column)
                    .count()
                    .where(F.col("count") > 1)
                    .agg(F.count(F.lit(1)).alias("f"))
                )
                parts.append(_result_row(dup, c, F.col("f")))
            elif c.kind == "relationships":
                parent = tables[c.to_model].select(F.col(c.to_column).alias(c.column)).where(F.col(c.column).isNotNull())
                orphans = (
                    df.where(F.col(c.column).isNotNull())
                    .select(c.column)
                    .join(parent, c.column, "left_anti")
                    .agg(F.count(F.lit(1)).alias("f"))
                )
                parts.append(_result_row(orphans, c, F.col("f")))
    results = reduce(DataFrame.unionByName, parts)
    status = (
        F.when(F.col("failures") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return results.withColumn("status", status)


def summarize(results: DataFrame) -> DataFrame:
    """Passed / total (a warning is not a pass), error failures and the gate."""
    return results.agg(
        F.count_if(F.col("status") == "pass").alias("tests_passed"),
        F.count(F.lit(1)).alias("tests_total"),
        F.count_if(F.col("status") == "warn").alias("tests_warned"),
        F.count_if(F.col("status") == "fail").alias("tests_failed"),
    ).withColumn("publishable", F.col("tests_failed") == 0)


def test_stats(run_results: DataFrame) -> DataFrame:
    """Passed / total from a prior run-results document: entries whose id
    starts with ``test.``; a missing document gives nulls (see sources.meta)."""
    tests = run_results.where(F.col("unique_id").startswith("test."))
    return tests.agg(
        F.count_if(F.col("status") == "pass").alias("tests_passed"),
        F.count(F.lit(1)).alias("tests_total"),
    )
