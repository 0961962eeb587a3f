"""Keyed merges, change feeds, upserts, deletes and fact merges on literal rows."""

import pytest

from tidemark.operators.latest import cdc_latest, keep_latest
from tidemark.operators.merge import (
    Clause, apply_cdc, delete_where, merge, merge_fact, missing_keys, scd1,
)
from tidemark.operators.rules import add_ingest_metadata

TARGET = "CUSTOMER_ID int, NAME string, STATUS string, _pipeline_run_id string, _source_system string, _cdc_operation string, ingest_date string"
FEED = "SYS_CHANGE_OPERATION string, SYS_CHANGE_VERSION int, CUSTOMER_ID int, _current_sync_version int, NAME string, STATUS string"


@pytest.fixture(scope="module")
def target(spark):
    names = {10: "Nora", 20: "Ivo", 30: "Lena"}
    return spark.createDataFrame([(i, n, "OPEN", "load-0", "SHOP", "I", "2021-06-30") for i, n in names.items()], TARGET)


@pytest.fixture(scope="module")
def feed(spark):
    changes = [
        ("I", 9, 50, 12, "Rui", "OPEN"),
        ("I", 8, 40, 12, "Omar", "OPEN"),
        ("D", 11, 20, 12, None, None),
        ("U", 12, 50, 12, "Rui", "CLOSED"),
        ("U", 10, 10, 12, "Nora Lind", "OPEN"),
    ]
    return add_ingest_metadata(spark.createDataFrame(changes, FEED), "load-1", "shop")


def state(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_cdc_hard_delete(target, feed):
    out = apply_cdc(target, feed, ["CUSTOMER_ID"])
    assert state(out, "CUSTOMER_ID", "NAME", "STATUS", "_cdc_operation") == [
        (10, "Nora Lind", "OPEN", "U"),
        (30, "Lena", "OPEN", "I"),
        (40, "Omar", "OPEN", "I"),
        (50, "Rui", "CLOSED", "U"),
    ]
    by_id = {r.CUSTOMER_ID: r for r in out.collect()}
    assert by_id[10].ingest_date == "2021-06-30"  # not overwritten by an update
    assert by_id[50]._cdc_version == 12 and by_id[30]._cdc_version is None
    assert "SYS_CHANGE_VERSION" not in out.columns


def test_cdc_is_idempotent_and_ignores_late_changes(spark, target, feed):
    once = apply_cdc(target, feed, ["CUSTOMER_ID"])
    twice = apply_cdc(once, feed, ["CUSTOMER_ID"])
    cols = ("CUSTOMER_ID", "NAME", "STATUS", "_cdc_version")
    key = lambda t: str(t)
    assert sorted(map(tuple, once.select(*cols).collect()), key=key) == sorted(
        map(tuple, twice.select(*cols).collect()), key=key
    )
    late = add_ingest_metadata(
        spark.createDataFrame([("U", 7, 50, 7, "Before", "NEW")], FEED), "run0", "crm"
    )
    after = apply_cdc(once, late, ["CUSTOMER_ID"])
    assert [r.STATUS for r in after.filter("CUSTOMER_ID = 50").collect()] == ["CLOSED"]


def test_cdc_soft_delete(target, feed):
    out = apply_cdc(target, feed, ["CUSTOMER_ID"], delete="soft")
    assert state(out, "CUSTOMER_ID", "_is_deleted") == [
        (10, False), (20, True), (30, False), (40, False), (50, False)
    ]
    assert out.filter("CUSTOMER_ID = 20").first().NAME == "Ivo"


def test_soft_delete_ignores_unmatched_delete(spark, target):
    f = add_ingest_metadata(spark.createDataFrame([("D", 13, 99, 13, None, None)], FEED), "r", "crm")
    assert apply_cdc(target, f, ["CUSTOMER_ID"], delete="soft").count() == 3


def test_merge_first_clause_wins_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "k int, v string, x int")
    s = spark.createDataFrame([(1, "A", 10), (2, "B", 20), (3, "C", 30), (None, "N", 40), (None, "N", 40)], "k int, v string, x int")
    out = merge(
        t, s, ["k"],
        [
            Clause("update", "s.x >= 20", {"v": "concat(t.v, s.v)"}),
            Clause("update", "s.x >= 10", {"x": "s.x"}),
            Clause("insert", "s.x >= 30"),
        ],
    )
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted(
        [(1, "a", 10), (2, "bB", 2), (3, "C", 30), (None, "n", 3), (None, "N", 40), (None, "N", 40)], key=str
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_merge_rejects_two_source_rows_for_one_key(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "A"), (1, "B")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        merge(t, s, ["k"], [Clause("update")]).collect()
    with pytest.raises(Exception, match="several source rows"):
        scd1(t, s, ["k"]).collect()


def test_scd1(spark):
    t = spark.createDataFrame([(7, "desk", 12), (8, "lamp", 4)], "k int, n string, amount int")
    s = spark.createDataFrame([(8, "lamp", 5), (9, "shelf", 1)], "k int, n string, amount int")
    once = scd1(t, s, ["k"])
    want = [(7, "desk", 12), (8, "lamp", 5), (9, "shelf", 1)]
    assert state(once, "k", "n", "amount") == want
    assert state(scd1(once, s, ["k"]), "k", "n", "amount") == want


def test_scd1_and_fact_merge_keep_columns_the_batch_lacks(spark):
    t = spark.createDataFrame([(1, "a", 1, 5), (2, "b", 1, 6)], "k int, n string, m int, x int")
    s = spark.createDataFrame([(1, "A", 1), (3, "C", 1)], "k int, n string, m int")
    assert state(scd1(t, s, ["k"]).fillna(-1), "k", "n", "x") == [(1, "A", 5), (2, "b", 6), (3, "C", -1)]
    assert state(merge_fact(t, s, "k", "m").fillna(-1), "k", "n", "x") == [(1, "A", 5), (2, "b", 6), (3, "C", -1)]


def test_keep_latest_order_fallbacks(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 6, "y"), (2, None, "z")], "k int, _cdc_version int, v string")
    assert state(keep_latest(df, ["k"]), "k", "v") == [(1, "y"), (2, "z")]
    plain = df.select("k", "v")
    assert sorted(r.k for r in keep_latest(plain, ["k"]).collect()) == [1, 2]
    tied = spark.createDataFrame([(1, 5, "b"), (1, 5, "a")], "k int, o int, v string")
    assert state(keep_latest(tied, ["k"], ["o"], ["v"]), "v") == [("a",)]


def test_keep_latest_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as SYS_CHANGE_VERSION")
    plan = cdc_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_delete_where_and_missing_keys(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "k int, v int")
    assert sorted(r.k for r in delete_where(df, "v < 0").collect()) == [1, 2]
    full = spark.createDataFrame([(1,), (3,)], "k int")
    assert [r.k for r in missing_keys(df, full, ["k"]).collect()] == [2]


def test_merge_fact_rewrites_only_touched_partitions(spark):
    cols = "line_id int, m int, v int, _created_date string"
    t = spark.createDataFrame([(1, 202301, 1, "d0"), (2, 202302, 2, "d0"), (3, 202303, 3, "d0"), (5, 202304, 5, "d0")], cols)
    s = spark.createDataFrame([(1, 202302, 10, "d1"), (4, 202302, 40, "d1")], cols)
    out = merge_fact(t, s, "line_id", "m")
    assert state(out, "line_id", "m", "v", "_created_date") == [
        (1, 202302, 10, "d0"), (2, 202302, 2, "d0"), (4, 202302, 40, "d1")
    ]


def test_merge_fact_null_partition_deletes_and_repeated_keys(spark):
    cols = "line_id int, m int, v int"
    t = spark.createDataFrame([(1, None, 1), (2, None, 2), (3, 5, 3), (4, 5, 4), (5, 6, 5)], cols)
    s = spark.createDataFrame([(1, 7, 10)], cols)
    want = [(1, 7, 10), (2, None, 2)]
    assert sorted(map(tuple, merge_fact(t, s, "line_id", "m").collect())) == want
    assert sorted(map(tuple, merge_fact(t, s, "line_id", "m", touched=[None, 7]).collect())) == want
    gone = spark.createDataFrame([(4,), (99,)], "line_id int")
    assert sorted(map(tuple, merge_fact(t, s, "line_id", "m", deleted=gone).collect())) == [*want, (3, 5, 3)]
    with pytest.raises(Exception, match="several source rows"):
        merge_fact(t, s.union(s), "line_id", "m").collect()
