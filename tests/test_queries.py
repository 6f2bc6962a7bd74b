"""Registered queries against the DuckDB oracle at sf0.001, plus the entry."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from sparktrips.sources.tables import TABLES

# A quick subset; tools/oracle_check.py runs all of them at sf0.01.
FAST = ["load_trips", "clean_trips", "retention_report", "avg_duration_by_hour", "describe_duration",
        "financial_summary", "corr_matrix", "histogram_money", "box_by_ratecode", "encode_features",
        "normalize_record", "exact_split", "validate_ranges", "rejects_by_rule", "latency_summary",
        "averages_by_code", "regression_metrics", "score_sink", "density_curve"]


def _canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float)):
        return repr(float(v))
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted(tuple(_canon(None if (not isinstance(x, str) and x is not None and x != x) else x)
                        for x in rec) for rec in pdf[cols].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 90


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, sf_small, name):
    s = E.queries()[name](spark, sf_small).toPandas()
    d = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _rows(s) == _rows(d)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 24
    assert df.columns == ["pickup_hour", "avg_duration", "trips"]
