"""Hidden events and tombstones behind the horizon go, and the history stays as it is."""

import random
from datetime import datetime as D
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import fold_events, scd2_feed, shown_versions
from tidemark.session import durable
from tidemark.streaming import jobs
from tidemark.streaming.state import PartitionedState

SCHEMA = "id int, status string, op string, seq long, at timestamp"
START = D(2023, 1, 1)


def event(key, status, hours, seq=0, op="U"):
    return (key, status, op, seq, START + timedelta(hours=hours))


def history(table):
    shown = shown_versions(table).select("id", "status", "_valid_from", "_valid_to", "_is_current", "_version")
    return sorted(map(tuple, shown.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_folding_keeps_the_history(spark, seed):
    """Random events that repeat states, delete, come back and arrive in any order inside the horizon."""
    rnd = random.Random(seed)
    batches = []
    for n in range(4):  # batch n has events from 24 * n - 24 to 24 * n + 24: half of it is late, none is too late
        times = [rnd.randrange(max(0, 24 * n - 24), 24 * n + 24) for _ in range(40)]
        batches.append(
            [event(rnd.randrange(5), rnd.choice("xy"), t, n * 100 + i, rnd.choice("UUUD")) for i, t in enumerate(times)]
        )
    plain = folded = None
    for n, rows in enumerate(batches):
        batch = spark.createDataFrame(rows, SCHEMA)
        args = (["id"], ["status"], "at", ["seq"], F.col("op") == "D")
        plain = durable(scd2_feed(plain, batch, *args), "plain")
        folded = durable(scd2_feed(folded, batch, *args), "folded")
        # the next batch starts at 24 * n
        folded = durable(fold_events(folded, ["id"], F.lit(START + timedelta(hours=24 * n)).cast("timestamp")), "folded")
        assert history(folded) == history(plain)
    old = F.col("_valid_from") < F.lit(START + timedelta(hours=72)).cast("timestamp")
    assert folded.filter(old & ~F.col("_shown")).count() == 0 < plain.filter(old & ~F.col("_shown")).count()
    assert folded.columns == plain.columns


def test_a_deleted_key_comes_back_after_folding(spark):
    args = (["id"], ["status"], "at", ["seq"], F.col("op") == "D")
    first = spark.createDataFrame([event(1, "x", 0, 1), event(1, None, 2, 2, "D"), event(1, None, 3, 3, "D")], SCHEMA)
    table = fold_events(scd2_feed(None, first, *args), ["id"], F.lit(START + timedelta(hours=10)).cast("timestamp"))
    table = durable(table, "folded")
    assert table.count() == 1
    back = scd2_feed(table, spark.createDataFrame([event(1, "x", 12, 4)], SCHEMA), *args)
    at = lambda hours: START + timedelta(hours=hours)
    assert history(back) == [(1, "x", at(0), at(2), False, 1), (1, "x", at(12), None, True, 2)]
    # a horizon before everything, and an empty table
    assert fold_events(back, ["id"], F.lit(START).cast("timestamp")).count() == back.count()
    assert fold_events(back.limit(0), ["id"], F.current_timestamp()).count() == 0


def run(spark, folder, name, files, **options):
    src = str(folder / f"{name}-src")
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = jobs.read_files(spark, src, spark.read.parquet(src).schema, 1)
        jobs.stream_apply_changes(
            stream, state := PartitionedState(spark, str(folder / name), jobs.BUCKET), str(folder / f"{name}-cp"), ["id"], "seq",
            op="op", buckets=1, **options,
        ).awaitTermination()
    return state


def test_stream_state_is_bounded(spark, tmp_path):
    # each file repeats a state every hour of its day; the last one also has an event of the first day
    files = [[event(1, "x" if day < 2 else "y", 24 * day + h, 24 * day + h + 1) for h in range(24)] for day in range(4)]
    files[3].append(event(1, "z", 5, 999))
    kw = {"scd": 2, "tracked": ["status"], "event_time": "at"}
    kept = run(spark, tmp_path, "kept", [*files[:3], files[3][:-1]], **kw)
    bounded = run(spark, tmp_path, "bounded", files, **kw, keep=86_400, late=str(tmp_path / "late"))
    assert history(bounded.read()) == history(kept.read())
    assert kept.read().count() == 96 and bounded.read().count() < 60
    late = spark.read.parquet(str(tmp_path / "late"))
    assert [(r.status, r.batch) for r in late.collect()] == [("z", 3)]
    assert bounded.horizon(0) is None and bounded.horizon(9) > bounded.horizon(1)


def test_stream_tombstones_retire(spark, tmp_path):
    files = [
        [event(1, "a", 0, 1, "I"), event(2, "b", 0, 2, "I"), event(2, None, 0, 3, "D"), event(3, None, 0, 4, "D")],
        [event(1, "c", 0, 20)],
        [event(1, "d", 0, 40), event(2, "late", 0, 2), event(3, "new", 0, 30, "I")],
    ]
    plain = run(spark, tmp_path, "plain", files)
    bounded = run(spark, tmp_path, "bounded", files, keep=10, late=str(tmp_path / "late"))
    rows = lambda s: sorted((r.id, r.status, r._cdc_version) for r in s.read().filter("NOT _is_deleted").collect())
    assert rows(bounded) == rows(plain) == [(1, "d", 40), (3, "new", 30)]
    assert plain.read().filter("_is_deleted").count() == 1 and bounded.read().filter("_is_deleted").count() == 0
    assert [r.status for r in spark.read.parquet(str(tmp_path / "late")).collect()] == ["late"]
    with pytest.raises(ValueError, match="go together"):
        run(spark, tmp_path, "half", files[:1], keep=10)
