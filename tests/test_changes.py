"""Runs over parts of the entities: every table equals one built anew from all of silver."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.maintain import maintain, summarise
from tidemark.plans import aggregates, facts, impact, medallion
from tidemark.plans.entities import ENTITIES
from tidemark.plans.medallion import run_medallion
from tidemark.sources.fixtures import Raw
from tidemark.streaming.state import PartitionedState

SF = "/root/testdata/sf0.001"
AUDIT = ("_created_date", "_last_modified_date", "_pipeline_run_id")


def same(left, right):
    columns = [c for c in left.columns if c not in AUDIT]
    a, b = (sorted(map(repr, side.select(*columns).collect())) for side in (left, right))
    assert a == b, (len(a), len(b), [x for x in a if x not in b][:3], [x for x in b if x not in a][:3])


def equals_rebuild(out):
    now = {n: medallion._current(out[n]) for n in ENTITIES}
    sales = facts.build_fact_sales(now["oe_order_lines_all"], now["oe_order_headers_all"], out, now["customer_registration_source"])
    same(out["fact_sales"], sales)
    same(out["fact_interactions"], facts.build_fact_interactions(now["interactions"], now["incidents"], out["dim_customer"]))
    same(out["fact_surveys"], facts.build_fact_surveys(now["surveys"], out["dim_customer"]))
    same(
        out["agg_monthly_campaign_roi"],
        aggregates.campaign_roi(sales, out["dim_date"], out["dim_campaign"], now["marketing_campaigns"]),
    )
    same(out["agg_customer_clv_metrics"], aggregates.customer_clv(sales, out["dim_customer"], out["dim_date"]))
    assert out["reconciliation"].first().matched


@pytest.fixture(scope="module")
def bronze(spark):
    """A small part of every entity, so that a run is mostly the work of its plan."""
    raw = Raw(spark, SF)
    tables = {n: getattr(raw, n)() for n in ENTITIES}
    cut = {
        "customers": "CUSTOMER_ID <= 60", "customer_registration_source": "CUSTOMER_ID <= 60", "addresses": "CUSTOMER_ID <= 60",
        "oe_order_headers_all": "ORDER_ID % 8 = 1", "oe_order_lines_all": "ORDER_ID % 8 = 1",
        "incidents": "INCIDENT_ID % 2 = 0", "surveys": "SURVEY_ID % 4 = 0",
    }
    rows = {n: (t.filter(cut[n]) if n in cut else t) for n, t in tables.items()}
    return {n: spark.createDataFrame(t.collect(), t.schema).coalesce(1) for n, t in rows.items()}


def run(spark, path, no, batch, before, **more):
    return run_medallion(spark, batch, str(path), no, before, now=datetime(2024, 1, 1 + no), error_limit=0.9, **more)


def test_runs_follow_changes(spark, bronze, tmp_path):
    # some customers, incidents, addresses, products, campaigns and lines come late
    late = {
        "customers": "CUSTOMER_ID % 4 = 0", "incidents": "INCIDENT_ID % 3 = 0", "addresses": "CUSTOMER_ID % 5 = 0",
        "mtl_system_items_b": "INVENTORY_ITEM_ID % 6 = 0", "marketing_campaigns": "CAMPAIGN_ID % 7 = 0",
        "customer_registration_source": "CUSTOMER_ID % 9 = 0", "oe_order_lines_all": "LINE_ID % 10 = 3",
    }
    first = run(spark, tmp_path, 0, {n: (t.filter(f"not ({late[n]})") if n in late else t) for n, t in bronze.items()}, None)
    assert first["fact_sales"].filter("dim_customer_key = -1").count() > 0
    # lookups alone change: customers and campaigns arrive, a customer's status changes, campaigns of some customers move
    crs = bronze["customer_registration_source"]
    changed = bronze["customers"].filter("CUSTOMER_ID < 30").withColumns(
        {"STATUS": F.lit("Churned"), "LAST_UPDATE_DATE": F.lit("1997-03-01")}
    )
    tables = run(spark, tmp_path, 1, {
        "customers": bronze["customers"].filter(f"{late['customers']} and CUSTOMER_ID >= 30").unionByName(changed),
        "customer_registration_source": crs.filter("CUSTOMER_ID % 2 = 0").withColumn("CAMPAIGN_ID", F.lit("3")),
        "incidents": bronze["incidents"].withColumn("_cdc_operation", F.lit("D")),
        **{n: bronze[n].filter(late[n]) for n in ("addresses", "mtl_system_items_b", "marketing_campaigns")},
    }, first)
    assert set(first) <= set(tables)
    assert tables["fact_interactions"].count() == 0
    assert tables["dim_customer"].filter("_version = 2").count() > 0
    equals_rebuild(tables)
    # orders move to another customer and month, lines change or go; one table is loaded anew as a whole
    headers, lines = bronze["oe_order_headers_all"], bronze["oe_order_lines_all"]
    batch = {
        "oe_order_headers_all": headers.filter("ORDER_ID % 3 = 0").withColumns(
            {"ORDER_DATE": F.add_months("ORDER_DATE", 5).cast("timestamp"), "CUSTOMER_ID": F.lit(7)}
        ),
        "oe_order_lines_all": lines.filter("LINE_ID % 4 = 1").withColumns(
            {"LINE_TOTAL": F.col("LINE_TOTAL") * 2, "_cdc_operation": F.when(F.expr("LINE_ID % 8 = 1"), F.lit("D")).otherwise(F.lit("U"))}
        ),
        "surveys": bronze["surveys"].filter("SURVEY_ID % 8 = 0"),
    }
    after = run(spark, tmp_path, 2, batch, tables, reload=["surveys"], keep_runs=2)
    assert 0 < after["fact_surveys"].count() < tables["fact_surveys"].count()
    equals_rebuild(after)
    # a run of nothing returns every table as it is
    again = run(spark, tmp_path, 3, {}, after)
    assert set(again) == set(after)
    assert again["fact_sales"].count() == after["fact_sales"].count()
    assert again["reconciliation"].first().matched


def test_maintained_extremes_and_null_groups(spark):
    schema = "g string, o int, s long, t long"
    rows = [("a", 1, 5, 1), ("a", 2, 7, 9), ("b", 3, 1, 4), (None, 4, 2, 2), (None, 5, None, 3), ("c", 6, 1, 1)]
    gone, come = [rows[0], rows[4], rows[5]], [("a", 1, 6, 4), ("d", 7, 1, None), ("b", 8, 1, 4)]
    frame = lambda r: spark.createDataFrame([(g, s, t, t) for g, _, s, t in r], "g string, s long, lo long, hi long")
    now = [r for r in rows if r not in gone] + come
    args = (["g"], ["s"], ["lo"], ["hi"])
    asked = []

    def whole(groups):
        asked.extend(r.g for r in groups.collect())
        return frame([r for r in now if r[0] in asked])

    got = maintain(summarise(frame(rows), *args), frame(gone), frame(come), *args, recompute=whole)
    same(got, summarise(frame(now), *args))
    assert sorted(asked, key=str) == [None, "a"]  # only groups that lost their least or greatest value


def test_changed_since(spark):
    schema = "k int, v int, _valid_from timestamp, _valid_to timestamp"
    day = lambda d: datetime(2024, 1, d)
    old = [(1, 10, day(1), None), (2, 20, day(1), day(9)), (3, 30, day(1), None), (4, 40, day(3), None)]
    new = [(1, 10, day(1), day(5)), (1, 11, day(5), None), (2, 20, day(1), day(9)), (3, 31, day(1), None), (5, 50, day(2), None)]
    got = impact.changed_since(*(spark.createDataFrame(r, schema) for r in (old, new)), "k", "v")
    assert {r.k: r.since for r in got.collect()} == {1: day(5), 3: day(1), 4: day(3), 5: day(2)}


def test_prune_keeps_what_later_readers_need(spark, tmp_path):
    state = PartitionedState(spark, str(tmp_path / "t"), "p")
    rows = lambda v, parts: spark.createDataFrame([(p, v) for p in parts], "p int, v int").withColumnRenamed("v", "x")
    for v, parts in enumerate([(1, 2, 3), (1,), (1, 2)]):
        state.write(rows(v, parts), [str(p) for p in parts], v)
    state.prune(1)
    want = [(1, 2), (2, 2), (3, 0)]
    assert sorted((r.p, r.x) for r in state.read().collect()) == want
    assert not (tmp_path / "t/data/v=0/p=1").exists() and (tmp_path / "t/data/v=0/p=2").exists() and (tmp_path / "t/data/v=1/p=1").exists()
    state.prune(2)
    state.prune(2)
    assert sorted((r.p, r.x) for r in state.read().collect()) == want
    assert not (tmp_path / "t/data/v=1/p=1").exists() and (tmp_path / "t/data/v=0/p=3").exists()
    assert state.committed(2) and state.buckets(10**9) == 64
    assert PartitionedState(spark, str(tmp_path / "u"), "p").buckets(10**9) == 4096
