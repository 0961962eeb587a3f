"""Registered queries: consistent registration, no nested loops, and a sample against DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "silver_oe_order_lines_all", "cdc_apply_hard_delete", "scd2_merge", "scd2_many_changes", "asof_status",
    "dq_rule_summary", "dim_customer", "fact_sales", "agg_monthly_campaign_roi", "metric_clv_by_customer",
)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_registration():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_sample(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    assert compare(df.columns, df.collect(), [d[0] for d in cur.description], cur.fetchall()) == ""


def test_no_query_plans_a_nested_loop_or_cross_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, fn in entry.queries().items():
            if name.startswith(("stream", "sink")):
                continue
            plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry.queries()["asof_status"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in plan
    plan = entry.queries()["any_row_per_key"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
