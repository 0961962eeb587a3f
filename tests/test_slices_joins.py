"""Sliced look-behind/ahead, point-in-time joins and salted joins against plain formulations and brute force."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import slices
from tidemark.operators.joins import asof_join, hot_keys, key_sketch, orphans, salted_lookup, sketched_keys, with_parent

T0 = datetime(2023, 1, 1)


def _timeline(spark, n=600, seed=1):
    rnd = random.Random(seed)
    # key 0 holds most of the rows
    data = [
        (0 if rnd.random() < 0.6 else rnd.randint(1, 20), i, T0 + timedelta(hours=rnd.randint(0, 2000), seconds=i),
         None if rnd.random() < 0.5 else rnd.randint(0, 9))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "k int, id int, t timestamp, v int")


def test_sliced_neighbours_equal_plain_windows(spark):
    df = _timeline(spark)
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select(
        "id",
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("p"),
        F.first("v", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("n"),
        F.row_number().over(w).alias("c"),
    )
    got = slices.with_slice(df, slices.day_slice("t"))
    got = slices.previous_value(got, ["k"], ["t", "id"], "v", "p")
    got = slices.next_value(got, ["k"], ["t", "id"], "v", "n")
    got = slices.running_count(got, ["k"], ["t", "id"], "c").select("id", "p", "n", "c")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_step_slice_equals_plain_window(spark):
    df = _timeline(spark, 200, 2)
    w = Window.partitionBy("k").orderBy("id")
    want = {r.id: r.c for r in df.select("id", F.row_number().over(w).alias("c")).collect()}
    got = slices.running_count(slices.with_slice(df, slices.step_slice("id", 16)), ["k"], ["id"], "c")
    assert {r.id: r.c for r in got.collect()} == want


def _versions(spark, seed=3):
    rnd = random.Random(seed)
    out, sk = [], 0
    for k in range(6):
        t = T0 + timedelta(days=rnd.randint(0, 10))
        for _ in range(200 if k == 0 else rnd.randint(1, 4)):
            end = t + timedelta(minutes=rnd.choice([30, 600, 4000]))
            sk += 1
            out.append([k, sk, t, end])
            t = end if rnd.random() < 0.9 else end + timedelta(hours=3)  # sometimes a gap
        if rnd.random() < 0.7:
            out[-1][3] = None
    return out


def test_asof_join_matches_brute_force_on_both_paths(spark):
    rnd = random.Random(4)
    versions = _versions(spark)
    facts = []
    for i in range(500):
        k = 0 if rnd.random() < 0.5 else rnd.choice([1, 2, 3, 4, 5, 99, None])
        t = None if rnd.random() < 0.05 else T0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 60))
        facts.append((i, k, t))
    # events exactly on a border belong to the newer version
    facts += [(1000 + j, v[0], v[2]) for j, v in enumerate(versions[:50])]
    far = datetime(2099, 12, 31)
    want = {
        i: next((v[1] for v in versions if v[0] == k and t is not None and v[2] <= t < (v[3] or far)), None)
        for i, k, t in facts
    }
    f = spark.createDataFrame(facts, "id int, k int, t timestamp")
    v = spark.createDataFrame(versions, "k int, sk int, _valid_from timestamp, _valid_to timestamp")
    for bound in (None, 64):
        got = asof_join(f, v, "k", "t", {"key": "sk"}, versions_per_key=bound)
        found = {r.id: r.key for r in got.collect()}
        assert found == want, bound


def test_asof_general_path_has_no_nested_loop_and_no_per_key_range_scan(spark):
    f = spark.createDataFrame([(1, 1, T0)], "id int, k int, t timestamp")
    v = spark.createDataFrame([(1, 1, T0, None)], "k int, sk int, _valid_from timestamp, _valid_to timestamp")
    plan = asof_join(f, v, "k", "t", {"key": "sk"})._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_salted_lookup_equals_plain_join(spark):
    rnd = random.Random(5)
    left = spark.createDataFrame(
        [(i, -1 if rnd.random() < 0.4 else rnd.choice([None, 1, 2, 3, 77])) for i in range(400)], "id int, k int"
    )
    right = spark.createDataFrame([(-1, "unknown"), (1, "a"), (2, "b"), (3, "c")], "k int, name string")
    for how in ("inner", "left"):
        for hot in ([-1], [], [1, 77]):
            got = salted_lookup(left, right, "k", hot, how, salts=8).select("id", "k", "name")
            want = left.join(right, "k", how).select("id", "k", "name")
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_hot_keys(spark):
    df = spark.createDataFrame([(1,)] * 60 + [(i,) for i in range(2, 42)], "k int")
    assert hot_keys(df, "k", 0.1) == [1]
    assert hot_keys(df.limit(0), "k") == [] and hot_keys(df.filter("k > 1"), "k", 0.1) == []
    # nulls have no share: each of the 40 other keys has 2.5 percent of the rest
    assert hot_keys(df.selectExpr("case when k > 1 then k end as k"), "k", 0.02) == list(range(2, 42))


def test_hot_keys_equal_counting(spark):
    # a key with a third of the rows, a few hundred frequent ones around the share, 40,000 rare ones, and nulls
    rows = spark.range(120_000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 3 = 1 then 100 + pmod(hash(id), 1 + id % 180) when id % 30 = 2 then null else id end as k"
    )
    counts = {r.k: r["count"] for r in rows.dropna().groupBy("k").count().collect()}
    total = sum(counts.values())
    for share in (0.005, 0.02, 0.4):
        want = sorted(k for k, n in counts.items() if n > total * share)
        assert hot_keys(rows, "k", share) == want
        # kept by batch and merged: none is missing, and what is there besides has nearly the share
        kept = key_sketch(rows.withColumn("batch", F.col("k") % 4), "k", share, ["batch"])
        got = sketched_keys(kept, share)
        assert set(want) <= set(got) and all(counts[k] > total * share / 4 for k in got)
    assert sketched_keys(kept.limit(0), 0.4) == []
    names = rows.selectExpr("concat('k', k) as k")
    assert hot_keys(names, "k", 0.3) == ["k7"]


def test_orphans_and_parents(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, k int")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(r.id for r in orphans(child, parent, "k").collect()) == [2, 3]
    assert [r.id for r in with_parent(child, parent, "k").collect()] == [1]
