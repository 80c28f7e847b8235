"""Every registered query against its DuckDB oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from gaugeflow.plans.catalog import QUERIES
from gaugeflow.plans.oracle import oracle_sql

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "supplier"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, want)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) - set(oracle_sql()) == {"lineage_nested"}
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "above_threshold" in df.columns
