"""Two runs of all layers over the smallest test data: the second must equal a rebuild from its silver tables."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import facts
from tidemark.plans.entities import ENTITIES
from tidemark.operators.contracts import SchemaDriftError
from tidemark.operators.quality import QualityError
from tidemark.plans.medallion import LOGGED, run_medallion
from tidemark.plans.published import check_published, published
from tidemark.sources.fixtures import Raw
from tidemark.streaming.jobs import BUCKET
from tidemark.streaming.state import PartitionedState

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_two_runs(spark, tmp_path):
    raw = Raw(spark, SF)
    path = str(tmp_path)
    bronze = {n: getattr(raw, n)() for n in ENTITIES}
    first = run_medallion(spark, bronze, path, 0, now=datetime(2024, 1, 1), error_limit=0.6)
    assert first["reconciliation"].first().matched
    assert {r.rule_id for r in first["ri_warnings"].collect()} == {"DQ-RI-001", "DQ-RI-002", "DQ-RI-003"}
    assert first["fact_sales"].count() > 0

    # second batch: customers change, some orders move by a year, the cancelled ones are deleted
    headers = bronze["oe_order_headers_all"]
    moved = headers.filter("ORDER_SOURCE = '1-URGENT'").withColumn(
        "ORDER_DATE", F.add_months("ORDER_DATE", 12).cast("timestamp")
    )
    gone = headers.filter("ORDER_SOURCE <> '1-URGENT' and ORDER_STATUS = 'Cancelled'").withColumn("_cdc_operation", F.lit("D"))
    batch = {
        "customers": raw.customers_change(),
        "oe_order_headers_all": moved.unionByName(gone),
        "oe_order_lines_all": bronze["oe_order_lines_all"].limit(0),
    }
    second = run_medallion(spark, batch, path, 1, first, now=datetime(2024, 1, 2), error_limit=0.6)

    dim = second["dim_customer"]
    assert dim.filter("_is_current").groupBy("customer_id").count().filter("count > 1").count() == 0
    assert dim.filter("_version = 2").count() > 0
    silver_headers = second["oe_order_headers_all"]
    assert silver_headers.filter("_is_deleted").count() == gone.join(
        first["oe_order_headers_all"].select("order_id"), "order_id"
    ).count()

    # facts of unchanged orders keep their version of the customer; those of moved orders are looked up again
    touched = second["oe_order_headers_all"].join(
        moved.select(F.col("ORDER_ID").alias("order_id")), "order_id", "left_semi"
    )
    want = facts.build_fact_sales(
        second["oe_order_lines_all"], touched, second, second["customer_registration_source"]
    ).select("line_id", "dim_customer_key", "order_year_month", "allocated_tax_amount")
    have = second["fact_sales"].join(touched.select("order_id"), "order_id", "left_semi").select(*want.columns)
    assert sorted(map(tuple, have.collect())) == sorted(map(tuple, want.collect()))
    assert second["fact_sales"].groupBy("line_id").count().filter("count > 1").count() == 0
    # a later batch of two customers rewrites their key buckets only
    few = raw.customers_change().filter("CUSTOMER_ID in ('1', '2')")
    third = run_medallion(spark, {"customers": few}, path, 2, second, now=datetime(2024, 1, 3), error_limit=0.6)
    written = PartitionedState(spark, f"{path}/silver/customers", BUCKET).versions()
    assert 1 <= sum(v == 2 for v in written.values()) <= 2 and len(written) > 10
    assert third["customers"].count() == second["customers"].count()
    with pytest.raises(SchemaDriftError):
        run_medallion(spark, {"customers": few.drop("EMAIL")}, path, 3, third, now=datetime(2024, 1, 4), error_limit=0.6)

    # facts of deleted orders are gone: the fact equals a rebuild of all orders, not only of the touched ones
    live = second["oe_order_headers_all"].filter("not _is_deleted")
    rebuilt = facts.build_fact_sales(second["oe_order_lines_all"], live, second, second["customer_registration_source"])
    assert sorted(r.line_id for r in second["fact_sales"].collect()) == sorted(r.line_id for r in rebuilt.collect())
    assert second["fact_sales"].count() < first["fact_sales"].count()
    total = second["fact_sales"].agg(F.sum("line_total")).first()[0]
    assert rebuilt.agg(F.sum("line_total")).first()[0] == total
    assert second["reconciliation"].first().matched
    log = spark.read.parquet(f"{path}/run_log")
    assert log.filter("pipeline_run_id = 'run-1'").count() == len(second)
    ids = {r.table_id: r.records_loaded for r in log.filter("pipeline_run_id = 'run-1'").collect()}
    assert ids[LOGGED.index("fact_sales")] == second["fact_sales"].count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_breaker_stops_the_run_and_is_logged(spark, tmp_path):
    surveys = Raw(spark, SF).surveys().withColumn("CSAT_SCORE", F.lit("99"))
    with pytest.raises(QualityError):
        run_medallion(spark, {"surveys": surveys}, str(tmp_path), 0, now=datetime(2024, 1, 1))
    row = spark.read.parquet(f"{tmp_path}/run_log").first()
    assert row.status == "FAILED" and row.table_id == LOGGED.index("surveys") and row.error_message


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_deleted_customers_are_published_as_deleted(spark, tmp_path):
    customers = Raw(spark, SF).customers()
    path = str(tmp_path)

    def run(no, batch, before):
        return run_medallion(spark, {"customers": batch}, path, no, before, now=datetime(2024, 1, 1 + no), error_limit=0.6)

    def flagged(tables):
        rows = published("dim_customer", tables["dim_customer"]).filter("_is_deleted").collect()
        assert all(r._is_current for r in rows)
        return sorted(r.customer_id for r in rows)

    first = run(0, customers, None)
    assert flagged(first) == []
    ids = sorted(r.customer_id for r in first["dim_customer"].filter("_is_current and customer_id > 0").collect())[:3]
    gone = customers.filter(F.col("CUSTOMER_ID").cast("long").isin(ids)).withColumn("_cdc_operation", F.lit("D"))
    second = run(1, gone, first)
    assert flagged(second) == sorted(map(str, ids))
    assert second["dim_customer"].count() == first["dim_customer"].count()
    # a later batch of other customers leaves the flags
    third = run(2, Raw(spark, SF).customers_change().filter(~F.col("CUSTOMER_ID").cast("long").isin(ids)), second)
    assert flagged(third) == sorted(map(str, ids))

    # the two published tables join on the customer's key, the unknown member included
    dim = third["dim_customer"]
    sales = dim.select(
        F.col("dim_customer_key").alias("line_id"), F.lit(1).alias("order_id"), "dim_customer_key",
        F.lit(1).alias("dim_product_key"), F.lit(1).alias("dim_campaign_key"), F.lit(20240101).alias("dim_date_key"),
        F.lit(1).alias("line_total"), F.lit("SHIPPED").alias("order_status"),
    )
    fact = published("fact_sales", sales, dim)
    joined = fact.join(published("dim_customer", dim), "customer_sk")
    assert joined.count() == sales.count() > 0
    assert not check_published("fact_sales", sales, dim)["breaking"]
    owner = dim.select(F.col("dim_customer_key").cast("string").alias("order_line_id"), F.col("customer_id").cast("string").alias("_owner"))
    assert joined.join(owner, "order_line_id").filter("customer_id <> _owner").count() == 0
