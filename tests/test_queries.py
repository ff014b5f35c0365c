"""Every registered query against its DuckDB oracle (sf0.001), plus entry()."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from dockhand.plans.catalog import load_all
from oracle import compare, duck

QUERIES = {name: fn for name, (fn, _) in load_all().items()}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == set()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name in ORACLES:
        ok, msg = compare(df, con, ORACLES[name])
        assert ok, msg
    else:
        assert df.count() >= 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    schema = df.schema
    assert df.count() > 0
    assert entry.entry(spark).schema == schema


# no Python worker in pure projection / conform / function queries
PYTHON_FREE = ["nan_to_null", "conform_schema", "rename_columns", "force_string", "parse_and_drop", "snake_case",
               "json_flatten", "map_subset", "parse_iso_ts", "iso_ts_parts", "business_date", "upsert_update",
               "latest_per_key", "fixed_size_batches", "retention_filter", "retire_by_interval"]


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_no_python_in_plan(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan


def test_pandas_transform_is_batch_local(spark):
    plan = QUERIES["pandas_transform"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "Exchange" not in plan


ZONE_SENSITIVE = ["time_window_extract", "list_segments", "retire_by_interval", "business_date", "parse_iso_ts",
                  "iso_ts_parts", "retention_filter", "dated_reload", "bulk_load_chunks", "completeness_gate"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg
