"""Rules, quality, dimensions, facts and aggregates on literal rows, and a two-batch run of all layers."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.masking import mask_email, mask_phone, mask_string
from tidemark.operators import quality as q
from tidemark.operators.contracts import CONTRACTS, schema_drift, to_contract, validate_contract
from tidemark.operators.governance import apply_policy, row_filter
from tidemark.operators.lineage import CycleError, dependency_levels, load_order
from tidemark.operators.rules import add_ingest_metadata, add_silver_metadata, apply_rules, lineage_rows, rule
from tidemark.operators.runlog import append_run, load_health, table_state
from tidemark.plans import aggregates, facts
from tidemark.plans.entities import ENTITIES, silver_rules, standardise
from tidemark.plans.quality_rules import CUSTOMER_LOAD_RULES, ORDER_LOAD_RULES, SILVER_DQ
from tidemark.operators.latest import keep_latest
from tidemark.sources.calendar import build_dim_date

D = datetime
NOW = D(2023, 5, 1)


def test_order_load(spark):
    raw = spark.createDataFrame(
        [("1", "10", "150.00"), ("2", "10", "-10.00"), ("3", "10", None), ("4", None, "20.00")],
        "ORDER_ID string, CUSTOMER_ID string, TOTAL_AMOUNT string",
    ).withColumn("_ingest_timestamp", F.lit(NOW)).withColumn("_cdc_operation", F.lit("I"))
    checked = q.dq_check(add_silver_metadata(standardise("oe_order_headers_all", raw), "r", NOW), ORDER_LOAD_RULES)
    m = q.load_metrics(raw, checked).first()
    assert (m.records_read, m.records_written, m.records_quarantined, m.records_filtered) == (4, 1, 3, 0)
    assert q.valid_rows(checked).first().total_amount == Decimal("150.00")


def test_customer_load(spark):
    raw = spark.createDataFrame(
        [("1", " Old@X.com", "active", D(2023, 1, 1)), ("1", " New@X.com ", " active", D(2023, 1, 2)),
         ("2", "b@x.com", None, D(2023, 1, 1)), (None, "c@x.com", "active", D(2023, 1, 1))],
        "CUSTOMER_ID string, EMAIL string, STATUS string, _ingest_timestamp timestamp",
    ).withColumn("_cdc_operation", F.lit("I"))
    rows = standardise("customers", keep_latest(raw, ["CUSTOMER_ID"]))
    checked = q.dq_check(rows, CUSTOMER_LOAD_RULES)
    m = q.load_metrics(raw, checked).first()
    assert (m.records_read, m.records_written, m.records_quarantined, m.records_filtered) == (4, 2, 1, 1)
    got = {r.customer_id: (r.email, r.status, r._dq_warnings) for r in q.valid_rows(checked).collect()}
    assert got == {1: ("new@x.com", "ACTIVE", []), 2: ("b@x.com", None, ["STATUS_IS_NULL"])}


def test_bad_casts_become_null_and_are_quarantined(spark):
    raw = spark.createDataFrame([("x", "a@b.co"), ("1", "a@b.co")], "CUSTOMER_ID string, EMAIL string")
    valid, bad = q.dq_split(standardise("customers", raw).withColumn("status", F.lit("A")), SILVER_DQ["customers"])
    assert valid.count() == 1 and bad.first()[q.FAILED] == ["DQ-N-001"]


def test_rules_order_inactive_and_unknown(spark):
    df = spark.createDataFrame([(" a ",), (None,)], "X string")
    rules = [
        rule("COALESCE", "y", "y", "'none'", 30), rule("UPPER", "y", "y", seq=20), rule("TRIM", "X", "y", seq=10),
        rule("FILTER", expression="y <> 'none'", seq=40), rule("RENAME", "y", "z", seq=50),
        rule("TRANSFORM", None, "z", "'off'", 60, active=False),
    ]
    assert [r.z for r in apply_rules(df, rules).collect()] == ["A"]
    with pytest.raises(ValueError):
        apply_rules(df, [rule("NOPE", "X")])
    assert lineage_rows(spark, "e", rules, "r").count() == 5


def test_metadata(spark):
    df = spark.createDataFrame([(1, "U")], "k int, SYS_CHANGE_OPERATION string")
    r = add_ingest_metadata(df, "run", "crm", now=NOW).first()
    assert (r._source_system, r._cdc_operation, r.ingest_date) == ("CRM", "U", "2023-05-01")
    assert add_ingest_metadata(df, "run", "crm", "I", NOW).first()._cdc_operation == "I"
    ops = spark.createDataFrame([("D",), ("U",), (None,)], "_cdc_operation string")
    assert [r._is_deleted for r in add_silver_metadata(ops, "r", NOW).collect()] == [True, False, False]
    assert add_silver_metadata(df, "r", NOW).first()._is_deleted is False


def test_every_entity_has_rules_and_quality():
    assert len(ENTITIES) == 13 and set(SILVER_DQ) == set(ENTITIES)
    ids = [r.rule_id for rules in SILVER_DQ.values() for r in rules]
    assert [f"DQ-N-{i:03d}" for i in range(1, 23)] == sorted(i for i in ids if i.startswith("DQ-N"))
    assert all(r["target_column"] for e in ENTITIES for r in silver_rules(e))


def test_warnings_keep_rows_and_email_rule(spark):
    df = spark.createDataFrame([(1, "a@b.co", "A"), (2, "invalid-email", "A"), (3, "a@b.c", "A")], "customer_id long, email string, status string")
    valid, bad = q.dq_split(df, SILVER_DQ["customers"])
    assert bad.count() == 0
    assert {r.customer_id: r[q.WARNED] for r in valid.collect()} == {1: [], 2: ["DQ-F-001"], 3: ["DQ-F-001"]}
    summary = {r.rule_id: r.failed_count for r in q.dq_summary(df, SILVER_DQ["customers"], "customers").collect()}
    assert summary == {"DQ-N-001": 0, "DQ-N-002": 0, "DQ-F-001": 2, "STATUS_IS_NULL": 0}


def test_threshold_and_circuit_breaker(spark):
    rules = SILVER_DQ["customers"]
    df = spark.createDataFrame([(None, "a@b.co", "A"), (1, "a@b.co", "A")], "customer_id long, email string, status string")
    share = q.error_share(q.dq_check(df, rules), rules, "customer_id")
    with pytest.raises(q.QualityError, match="50.00%"):
        q.enforce_threshold(share)
    q.enforce_threshold(share, 0.6)
    nulls = q.error_share(q.dq_check(df.filter("customer_id is null"), rules), rules, "customer_id")
    with pytest.raises(q.QualityError, match="every key"):
        q.enforce_threshold(nulls, 2.0)


def test_dead_letters(spark):
    df = spark.createDataFrame([(1, 99, 0), (None, 5, 3)], "survey_id long, nps_score int, csat_score int").withColumn("customer_id", F.lit(1))
    _, bad = q.dq_split(df, SILVER_DQ["surveys"])
    log = q.dlq_rows(bad, SILVER_DQ["surveys"], "r1", "surveys", NOW)
    assert sorted((r.rule_id, r.rule_type, r.column_name, r.severity) for r in log.collect()) == [
        ("DQ-N-021", "NULL_CHECK", "survey_id", "SKIP_ROW"), ("DQ-R-001", "RANGE_CHECK", "nps_score", "SKIP_ROW"),
        ("DQ-R-002", "RANGE_CHECK", "csat_score", "SKIP_ROW"),
    ]
    assert log.filter("rule_id = 'DQ-R-001'").first().row_data.startswith('{"survey_id":1')


def test_drift_and_contract(spark):
    bronze = spark.createDataFrame([(1, "a", "c")], "BRAND_ID int, brand_name string, new_brand_category string")
    silver = spark.createDataFrame([(1, "a", True)], "brand_id bigint, brand_name string, _is_deleted boolean")
    assert schema_drift(bronze, silver) == {
        "new_columns": ["new_brand_category"], "missing_columns": [], "retyped_columns": ["brand_id"]
    }
    metrics = spark.createDataFrame([(1, 10.0, 1.0, 5.0), (1, 10.0, 1.0, 5.0)], "customer_id int, average_order_value double, purchase_frequency double, revenue double")
    c = CONTRACTS["agg_customer_clv_metrics"]
    assert validate_contract(metrics, c)["breaking"]
    shaped = to_contract(metrics, c, {"total_lifetime_revenue": "revenue"})
    report = validate_contract(shaped, c)
    assert report["issues"] == [] and report["duplicate_keys"] == 1 and report["breaking"]
    assert not validate_contract(shaped.limit(1).withColumn("extra", F.lit(1)), c)["breaking"]


def test_masks_policy_and_row_filter(spark):
    df = spark.createDataFrame([("jane@x.com", "5551234567", "Jane"), ("noat", "12", None), (None, None, "Al")], "email string, phone string, first_name string")
    got = df.select(mask_email("email"), mask_phone("phone"), mask_string("first_name")).collect()
    assert [tuple(r) for r in got] == [
        ("j***@x.com", "***-***-4567", "[REDACTED]"), ("[REDACTED]", "***-***-12", None), (None, None, "[REDACTED]")
    ]
    assert apply_policy(df, "customers", ["pii_readers"]) is df
    with pytest.raises(ValueError, match="last_name"):  # a masked column is absent: it may have another name
        apply_policy(df, "customers", [])
    upper = df.withColumn("last_name", F.lit("Doe")).toDF("EMAIL", "Phone", "FIRST_NAME", "LAST_NAME")
    assert tuple(apply_policy(upper, "CUSTOMERS", []).first()) == ("j***@x.com", "***-***-4567", "[REDACTED]", "[REDACTED]")
    regions = spark.createDataFrame([("NA",), ("EMEA",), ("APAC",)], "region string")
    assert [r.region for r in row_filter(regions, "region", ["analysts_na"]).collect()] == ["NA"]
    assert row_filter(regions, "region", []).count() == 0
    assert row_filter(regions, "region", ["gov_admins"]).count() == 3


def test_dependency_levels_and_cycles(spark):
    tables = ["CUSTOMERS", "CAMPAIGNS", "CITY", "ADDRESSES", "HEADERS", "LINES", "ITEMS", "BRANDS"]
    nodes = spark.createDataFrame([(t, t, 10) for t in tables], "node string, table_name string, load_priority int")
    edges = spark.createDataFrame(
        [("ADDRESSES", "CUSTOMERS"), ("ADDRESSES", "CITY"), ("HEADERS", "CUSTOMERS"), ("HEADERS", "ADDRESSES"),
         ("LINES", "HEADERS"), ("LINES", "ITEMS"), ("ITEMS", "BRANDS"), ("ITEMS", "GONE")],
        "node string, depends_on string",
    )
    got = [(r.node, r.level) for r in load_order(nodes, edges).collect()]
    assert got == [
        ("BRANDS", 0), ("CAMPAIGNS", 0), ("CITY", 0), ("CUSTOMERS", 0), ("ADDRESSES", 1), ("ITEMS", 1), ("HEADERS", 2),
        ("LINES", 3),
    ]
    loop = edges.unionByName(spark.createDataFrame([("CUSTOMERS", "LINES")], edges.schema))
    with pytest.raises(CycleError):
        dependency_levels(nodes, loop)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    append_run(spark, path, 1, "a", "SUCCESS", 10, 100, mark_initial=True, ended_at=D(2023, 1, 1))
    append_run(spark, path, 1, "b", "SUCCESS", 5, 105, ended_at=D(2023, 1, 2))
    append_run(spark, path, 1, "c", "FAILED", 0, 110, error="boom", ended_at=D(2023, 1, 3))
    append_run(spark, path, 2, "d", "SUCCESS", 7, 50, ended_at=D(2023, 1, 2))
    append_run(spark, path, 2, "e", "SUCCESS", 7, None, full_reload=True, ended_at=D(2023, 1, 3))
    state = {r.table_id: r for r in table_state(spark.read.parquet(path)).collect()}
    assert (state[1].last_status, state[1].last_sync_version, state[1].initial_load_completed) == ("FAILED", 105, True)
    assert (state[1].records_loaded, state[1].total_records_loaded) == (0, 15)
    assert state[2].last_sync_version == 0 and not state[2].initial_load_completed
    health = {r.table_id: r for r in load_health(spark.read.parquet(path), D(2023, 1, 3, 12)).collect()}
    assert health[1].lag_hours == 36 and health[1].lag_alert and not health[2].no_data_alert


def test_dim_date(spark):
    d = build_dim_date(spark)
    assert d.count() == 5844 and len(d.columns) == 13
    r = d.filter("dim_date_key = 20230101").first()
    assert (r.day_of_week, r.day_name, r.is_weekend, r.week_of_year, r.month_name) == (1, "Sunday", True, 52, "January")


HEADER = ("order_id long, order_number string, customer_id long, shipping_address_id long, order_date timestamp, order_status string, "
          "subtotal_amount decimal(15,2), discount_amount decimal(15,2), tax_amount decimal(15,2)")
LINE = "line_id long, order_id long, product_id long, quantity int, unit_price decimal(15,2), line_total decimal(15,2)"


def _dims(spark):
    return {
        "dim_customer": spark.createDataFrame([(999, 100, D(2020, 1, 1), None)], "dim_customer_key long, customer_id long, _valid_from timestamp, _valid_to timestamp"),
        "dim_product": spark.createDataFrame([], "dim_product_key long, inventory_item_id long"),
        "dim_location": spark.createDataFrame([], "dim_location_key long, address_id long"),
        "dim_campaign": spark.createDataFrame([(7, 5)], "dim_campaign_key long, campaign_id int"),
    }


def test_fact_sales(spark):
    headers = spark.createDataFrame([(1, "O1", 100, 5, D(2023, 5, 10), "DELIVERED", Decimal(100), Decimal(10), Decimal(5)),
                                     (2, "O2", None, None, D(2023, 5, 11), "BOOKED", Decimal(0), Decimal(1), Decimal(1))], HEADER)
    lines = spark.createDataFrame([(10, 1, 200, 2, Decimal(50), Decimal(100)), (11, 1, 201, 1, Decimal(-10), Decimal(-10)),
                                   (12, 1, 202, 0, Decimal(50), Decimal(50)), (13, 2, 200, 1, Decimal(5), Decimal(5))], LINE)
    crs = spark.createDataFrame([(100, "Organic", None), (100, "Organic", None)], "customer_id long, channel string, campaign_id int")
    for bound in (None, 3):
        got = {r.line_id: r for r in facts.build_fact_sales(lines, headers, _dims(spark), crs, "r", NOW, bound).collect()}
        assert sorted(got) == [10, 13]  # a repeated registration source multiplies nothing
        r = got[10]
        assert (r.dim_customer_key, r.dim_product_key, r.dim_location_key, r.dim_campaign_key) == (999, -1, -1, -2)
        assert (r.allocated_discount_amount, r.allocated_tax_amount, r.order_year_month, r.dim_date_key) == (
            Decimal("10.00"), Decimal("5.00"), 202305, 20230510)
        assert (got[13].dim_customer_key, got[13].dim_campaign_key, got[13].allocated_tax_amount) == (-1, -1, None)


def _fact(spark, rows):
    return spark.createDataFrame(rows, "dim_date_key int, dim_customer_key long, dim_campaign_key long, order_number string, quantity int, line_total decimal(15,2)")


def test_customer_metrics(spark):
    fact = _fact(spark, [(20230101, 1, 1, "A", 1, Decimal(100)), (20230101, 1, 1, "A", 1, Decimal(50)), (20230302, 1, 1, "B", 2, Decimal(150))])
    cust = spark.createDataFrame([(1, 1001, "ACTIVE", D(2023, 1, 1), D(2022, 12, 31), True)], "dim_customer_key long, customer_id long, status string, _valid_from timestamp, registration_date timestamp, _is_current boolean")
    r = aggregates.customer_clv(fact, cust, build_dim_date(spark)).first()
    assert (r.average_order_value, r.purchase_frequency, r.lifetime_revenue, r.total_orders) == (150, 1.0, 300, 2)
    assert (r.total_items_purchased, r.customer_lifespan_days, r.first_order_date) == (4, 61, date(2023, 1, 1))
    one = aggregates.customer_clv(fact.filter("order_number = 'A'"), cust, build_dim_date(spark)).first()
    assert one.purchase_frequency is None and one.total_orders == 1
    by = aggregates.customer_clv_by_customer(fact, cust, build_dim_date(spark)).first()
    assert (by.customer_id, by.total_orders, by.lifespan_months) == (1001, 2, 2)


def test_campaign_roi(spark):
    fact = _fact(spark, [(20230101, 1, 10, "O1", 2, Decimal(100)), (20230115, 1, 10, "O2", 1, Decimal(50)), (20230120, 2, -2, "O3", 5, Decimal(200))])
    camp = spark.createDataFrame([(10, 100, "Promo", "Paid Social"), (-2, -2, "ORGANIC", "ORGANIC")], "dim_campaign_key long, campaign_id int, campaign_name string, channel string")
    spend = spark.createDataFrame([(100, Decimal(500), 10)], "campaign_id int, total_spend decimal(15,2), customers_acquired int")
    got = {r.dim_campaign_key: r for r in aggregates.campaign_roi(fact, build_dim_date(spark), camp, spend).collect()}
    assert got[-2].customer_acquisition_cost == Decimal("0.00") and got[-2].return_on_ad_spend is None
    assert got[10].customer_acquisition_cost == Decimal("50.00") and got[10].return_on_ad_spend == Decimal("0.30")
    assert (got[10].total_orders, got[10].year_month) == (2, 202301)
    roi = aggregates.campaign_roi(fact, build_dim_date(spark), camp, spend)
    assert q.reconcile_sum(roi, "total_revenue", fact, "line_total").first().matched
    bad = aggregates.apply_agg_rules(fact, [{"aggregation_type": "SUM", "source_column": "line_total", "target_column": "t", "filter_expression": "quantity > 1"}])
    assert bad[""].first().t == Decimal(300)


def test_unknown_usage(spark):
    fact = spark.createDataFrame([(-1, 1), (2, 1), (3, 1), (4, 1)], "a long, b long")
    got = {r.key_column: (float(r.unknown_pct), r.over_threshold) for r in q.unknown_usage(fact, ["a", "b"]).collect()}
    assert got == {"a": (25.0, True), "b": (0.0, False)}
