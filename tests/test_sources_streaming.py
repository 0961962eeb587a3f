"""Scans, extracts, sinks, partitioned state and streaming jobs."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError
from tidemark.plans.quality_rules import SILVER_DQ
from tidemark.session import drop_scratch, durable, scratch_mark
from tidemark.sources import sinks
from tidemark.sources.increments import cdc_changes, read_increment, split_key_list
from tidemark.sources.tables import is_empty, jdbc_options, load_tables, read_batch
from tidemark.streaming import jobs
from tidemark.streaming.state import PartitionedState

D = datetime


def test_read_batch_merges_additive_columns(spark, tmp_path):
    p = str(tmp_path / "b")
    spark.createDataFrame([(1,)], "k int").write.parquet(p)
    spark.createDataFrame([(2, "x")], "k int, extra string").write.mode("append").parquet(p)
    df = read_batch(spark, p)
    assert set(df.columns) == {"k", "extra"} and df.count() == 2
    assert read_batch(spark, p, df.schema).count() == 2
    assert not is_empty(df) and is_empty(df.filter("k > 9"))
    got = load_tables(spark, str(tmp_path), ["b"], register=True)
    assert spark.sql("select count(*) n from b").first().n == 2 and set(got) == {"b"}


def test_jdbc_options():
    assert jdbc_options("u", "select 1") == {"url": "u", "fetchsize": "10000", "query": "select 1"}
    o = jdbc_options("u", "select * from t", "id", 0, 100, 8, driver="d")
    assert o["dbtable"] == "(select * from t) src" and o["numPartitions"] == "8" and o["driver"] == "d"
    assert jdbc_options("u", "s.t")["dbtable"] == "s.t"
    with pytest.raises(ValueError):
        jdbc_options("u", "s.t", "id")


def test_increment_bounds_lookback_and_pushdown(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(i, D(2023, 1, i)) for i in range(1, 11)], "k int, ts timestamp").write.parquet(p)
    df = spark.read.parquet(p)
    got = read_increment(df, "ts", D(2023, 1, 4), D(2023, 1, 8))
    assert sorted(r.k for r in got.collect()) == [5, 6, 7, 8]
    back = read_increment(df, "ts", D(2023, 1, 4), D(2023, 1, 8), timedelta(days=2))
    assert sorted(r.k for r in back.collect()) == [3, 4, 5, 6, 7, 8]
    assert read_increment(df, "ts", None, D(2023, 1, 8)).count() == 8
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_cdc_changes_keeps_deleted_keys(spark):
    feed = spark.createDataFrame([(1, "U", 5), (2, "D", 6)], "a int, SYS_CHANGE_OPERATION string, SYS_CHANGE_VERSION long")
    base = spark.createDataFrame([(1, "x"), (3, "z")], "a int, v string")
    got = {r.a: (r.v, r._current_sync_version) for r in cdc_changes(feed, base, split_key_list(" a "), 9).collect()}
    assert got == {1: ("x", 9), 2: (None, 9)}


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "id % 3 as m", "id % 7 as c")
    sinks.write_table(df, p, partition_by=["m"], cluster_by=["c"])
    sinks.overwrite_partitions(df.filter("m = 1").limit(5), p, ["m"])
    got = {r.m: r["count"] for r in spark.read.parquet(p).groupBy("m").count().collect()}
    assert got == {0: 334, 1: 5, 2: 333}
    sinks.append_table(df.filter("m = 1").limit(2).select("id", "c", "m"), p + "2")
    sinks.append_table(df.limit(2).select("id", "c", "m"), p + "2")
    assert spark.read.parquet(p + "2").count() == 4


def test_clustered_splits_a_hot_value(spark):
    hot = spark.range(20_000).selectExpr("id", "case when id % 3 = 0 then 7 else id end as k")
    sizes = [r["count"] for r in sinks.clustered(hot, ["k"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 20_000 / 3


def test_state_commits_and_emptied_partitions(spark, tmp_path):
    state = PartitionedState(spark, str(tmp_path / "s"), "m")
    assert state.read() is None and not state.committed(0)
    df = spark.createDataFrame([(1, 10), (2, 20)], "k int, m int")
    state.write(df, ["10", "20"], 0)
    state.write(spark.createDataFrame([(1, 20), (2, 20)], "k int, m int"), ["10", "20"], 1)
    assert sorted((r.k, r.m) for r in state.read().collect()) == [(1, 20), (2, 20)]
    assert state.read(["10"]).count() == 0 and state.committed(1)
    # a batch that wrote files but never committed is invisible
    df.write.mode("overwrite").partitionBy("m").parquet(str(tmp_path / "s/data/v=2"))
    assert sorted((r.k, r.m) for r in state.read().collect()) == [(1, 20), (2, 20)]


FEED = "id long, op string, seq long, name string"


def _drain(spark, tmp_path, rows_per_file, name, **kwargs):
    src = str(tmp_path / f"{name}-src")
    for i, rows in enumerate(rows_per_file):
        spark.createDataFrame(rows, kwargs.get("schema", FEED)).coalesce(1).write.mode("append").parquet(src)
    return src


def test_stream_scd1_is_order_independent(spark, tmp_path):
    changes = [(1, "I", 1, "a1"), (1, "U", 4, "a4"), (1, "U", 3, "a3"), (2, "I", 2, "b2"), (2, "D", 5, None),
               (3, "D", 9, None), (3, "I", 6, "late")]
    want = {1: ("a4", False, 4), 2: ("b2", True, 5), 3: (None, True, 9)}
    for n, files in enumerate(([changes[:3], changes[3:6], changes[6:]], [changes[6:], changes[3:6], changes[:3]])):
        src = _drain(spark, tmp_path, files, f"s{n}")
        state = PartitionedState(spark, str(tmp_path / f"st{n}"), jobs.BUCKET)
        stream = jobs.read_files(spark, src, spark.read.parquet(src).schema, 1)
        jobs.stream_apply_changes(stream, state, str(tmp_path / f"cp{n}"), ["id"], "seq", op="op", buckets=4).awaitTermination()
        got = {r.id: (r.name, r._is_deleted, r._cdc_version) for r in state.read().collect()}
        assert got[1] == want[1] and got[2][1:] == want[2][1:] and got[3][1:] == want[3][1:]
        # nothing new: a second drain changes nothing
        jobs.stream_apply_changes(stream, state, str(tmp_path / f"cp{n}"), ["id"], "seq", op="op", buckets=4).awaitTermination()
        assert state.read().count() == 3


def test_retry_of_a_committed_batch_is_a_no_op(spark, tmp_path):
    state = PartitionedState(spark, str(tmp_path / "s"), jobs.BUCKET)
    batch = spark.createDataFrame([(1, "x")], "id long, v string")
    calls = []

    def change(target, rows):
        calls.append(1)
        return rows

    jobs.apply_to_state(state, batch, 3, ["id"], 4, change)
    jobs.apply_to_state(state, batch, 3, ["id"], 4, change)
    assert len(calls) == 1 and state.read().count() == 1


def test_stream_quality_can_stop_the_query(spark, tmp_path):
    schema = "customer_id long, email string, status string"
    src = _drain(spark, tmp_path, [[(None, "a@b.co", "A"), (1, "a@b.co", None)]], "q", schema=schema)
    stream = jobs.read_files(spark, src, spark.read.parquet(src).schema)
    ok = str(tmp_path / "ok")
    jobs.stream_quality(stream, ok, str(tmp_path / "c1"), SILVER_DQ["customers"]).awaitTermination()
    assert jobs.read_quality(spark, ok, True).count() == 1 and jobs.read_quality(spark, ok, False).count() == 1
    with pytest.raises(Exception, match="50.00%"):
        jobs.stream_quality(
            stream, str(tmp_path / "no"), str(tmp_path / "c2"), SILVER_DQ["customers"], 0.05, "customer_id"
        ).awaitTermination()
    assert issubclass(QualityError, RuntimeError)


def test_stream_dedupe_and_bronze(spark, tmp_path):
    schema = "id long, ts timestamp"
    rows = [(i, D(2023, 1, 1) + timedelta(minutes=i)) for i in range(20)]
    src = _drain(spark, tmp_path, [rows, rows[:10]], "d", schema=schema)
    stream = jobs.dedupe_appends(jobs.read_files(spark, src, spark.read.parquet(src).schema, 1), ["id"], "ts", "1 hour")
    out = str(tmp_path / "out")
    jobs.stream_bronze(stream, out, str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(out).count() == 20


def test_staged_tables_are_given_back(spark):
    first = durable(spark.range(3), "kept")
    mark = scratch_mark()
    second = durable(spark.range(5), "gone")
    folder = second.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder) and second.count() == 5
    drop_scratch(spark, mark)
    assert not os.path.exists(folder) and first.count() == 3
