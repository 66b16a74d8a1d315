"""Registered queries against their DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from partwise.plans import catalog

TABLES = ("orders", "lineitem", "part")
FAST = [
    "bronze_cmm",
    "part_population",
    "cmm_rollup",
    "torque_rollup",
    "material_quality",
    "quality_flags",
    "part_quality_summary",
    "headline_metrics",
    "daily_defect_trend",
    "failing_dimensions",
    "correlation_matrix",
    "filter_options",
    "part_trace_cmm",
    "part_trace_cert",
    "part_options",
    "filtered_headline_metrics",
    "filtered_failing_dimensions",
    "filtered_correlation_matrix",
    "bronze_load_manifest",
    "bronze_overlapping_loads",
    "bronze_rerun_day",
    "bronze_rerun_second_day",
    "gold_from_bronze_files",
    "gold_from_drifted_bronze",
    "gold_round_trip",
    "dq_suite",
    "verdict_audit",
]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_of_the_model_has_an_oracle():
    """Training-data queries that SQL cannot express are held against brute force in tests/llm."""
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(o)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in cur.description]
    want = [tuple(r) for r in cur.fetchall()]
    assert sorted(got_cols) == sorted(want_cols)
    assert _rows(got_cols, got) == _rows(want_cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "part_id" and len(df.columns) == 31
    assert df.count() > 0
