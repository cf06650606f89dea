"""Driver contract: entry runs; every SQL-checked query equals its DuckDB twin."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as ent
from conftest import SF_SMOKE
from trip_engine.registry import ORACLE, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v.is_integer() and abs(v) < 2**53:
            return str(int(v))
        return repr(v)
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = ent.entry(spark)
    rows = df.collect()
    assert df.columns == ["airport", "hour_of_day", "trip_count"] and len(rows) > 0


def test_every_oracle_key_is_a_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ours = ent.queries()[name](spark, SF_SMOKE).toPandas()
    theirs = con.execute(ent.oracle_sql()[name]).df()
    assert _rows(ours) == _rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"score_stream", "score_batch"}))
def test_no_python_evaluation_in_plans(spark, name):
    from trip_engine.plans.inspect import plan_text
    plan = plan_text(ent.queries()[name](spark, SF_SMOKE), "extended")
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                 "FlatMapGroupsInPandas"):
        assert node not in plan, (name, node)


@pytest.mark.parametrize("name", ["market_share", "grid_density", "check_unique",
                                  "consolidated_trips", "airport_cube", "check_not_null",
                                  "run_contract", "airport_trips_by_weekday"])
def test_aggregates_shuffle_only_partial_results(spark, name):
    """Plan shape: every hash exchange sits directly on an aggregate, i.e.
    raw rows are never shuffled before map-side combining."""
    from trip_engine.plans.inspect import physical_plan
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = physical_plan(ent.queries()[name](spark, SF_SMOKE))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "HashAggregate" in lines[i + 1], (name, plan)
