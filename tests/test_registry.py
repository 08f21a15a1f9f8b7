"""Every registered query against its DuckDB statement, and the shape of its plan."""
from __future__ import annotations

import pytest

from check import compare, connect
from growthloom.registry import ORACLE, QUERIES

@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf, name):
    problem, _, _ = compare(spark, duck, name, sf)
    assert problem is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"]
# These run jobs to build their frame; their plans are read-backs.
EAGER = {"json_sink", "csv_sink", "append_sink", "scan_table", "scan_hooks_json", "daily_close", "daily_mart_backfill",
         "version_chain", "table_layout", "late_day_rebuild", "production_order", "production_manifest", "production_manifest_text", "zip_by_position"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in EAGER and not n.startswith("stream_")))
def test_plan_has_no_slow_path(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = QUERIES["day_slice"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(ts), Not(EqualTo(event_type,error)), GreaterThanOrEqual(ts,2024" in plan
    assert "value:double" not in plan.split("ReadSchema")[1]
    counts = QUERIES["check_unique"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in counts
