"""Streaming jobs. Each returns a started query; ``availableNow`` drains what is there and stops."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.history import fold_events, scd2_feed
from tidemark.operators.merge import apply_cdc, one_row_per_key, with_first_values
from tidemark.operators.quality import FAILED, Rule, dq_check, enforce_threshold, error_share
from tidemark.session import durable, parts_for
from tidemark.streaming.state import NULL_FOLDER, PartitionedState, touched_values

BUCKET = "_bucket"


def read_files(
    spark: SparkSession, directory: str, schema: StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Incremental Parquet source. The schema is given: a stream never infers it."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(directory)


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], once: bool) -> StreamingQuery:
    def cached(batch: DataFrame, batch_id: int) -> None:
        # a batch is looked at several times; what an executor loses is read again from the source files
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            each(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(cached)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def stream_bronze(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the stream to a bronze folder, exactly once (file sink with a checkpoint)."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def dedupe_appends(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeated events of a pure append feed. State is bounded by the watermark delay."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def apply_to_state(
    state: PartitionedState,
    batch: DataFrame,
    batch_id: int,
    keys: Sequence[str],
    buckets: int,
    change: Callable[[DataFrame | None, DataFrame], DataFrame],
) -> None:
    """One micro-batch: read the touched key buckets, change them, write them as a new version."""
    if state.committed(batch_id) or batch.isEmpty():
        return
    rows = with_bucket(batch, keys, buckets)
    touched = touched_values(rows, BUCKET)
    target = state.read(touched)
    changed = change(target.drop(BUCKET) if target is not None else None, batch)
    state.write(with_bucket(changed, keys, buckets), touched, batch_id)


def stream_apply_changes(
    stream: DataFrame,
    state: PartitionedState,
    checkpoint: str,
    keys: Sequence[str],
    sequence: str,
    scd: int = 1,
    op: str = "SYS_CHANGE_OPERATION",
    tracked: Sequence[str] = (),
    event_time: str | None = None,
    buckets: int = 64,
    once: bool = True,
    keep: int | None = None,
    late: str | None = None,
) -> StreamingQuery:
    """Apply a change stream in ``sequence`` order, whatever order it arrives in.

    SCD 1 keeps deleted rows as soft deletes: their version must stay, or a late update would bring the row back.
    SCD 2 chains every change of a key into versions and keeps all events (``shown_versions`` gives the versions); a
    delete closes the version before it.

    With ``keep``, the state is bounded. What is more than ``keep`` behind the newest event of earlier batches (units of
    ``sequence`` for SCD 1, seconds of ``event_time`` for SCD 2, where moments in the future count as now) is late: it goes to
    the folder ``late``, a subfolder for each batch, and not into the table. Tombstones and hidden events beyond it can't
    matter any more and are dropped from the buckets a batch touches. Everything else is as without ``keep``.
    """
    if (keep is None) != (late is None):
        raise ValueError("keep and late go together")

    def scd1(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        if target is None:
            # an empty table of the same shape: a key first seen as a delete becomes a tombstone
            target = batch.limit(0).drop(op, sequence).withColumns(
                {"_cdc_version": F.lit(None).cast("long"), "_is_deleted": F.lit(False)}
            )
        return apply_cdc(target, batch, keys, delete="soft", op=op, version=sequence, tombstones=True)

    def scd2(target: DataFrame | None, batch: DataFrame) -> DataFrame:
        gone = F.col(op) == "D" if op in batch.columns else None
        return scd2_feed(target, batch, keys, tracked, event_time, [sequence], gone)

    change = scd1 if scd == 1 else scd2

    def fold(rows: DataFrame, limit: int) -> DataFrame:
        if scd == 1:
            return rows.filter(~F.coalesce(F.col("_is_deleted") & (F.col("_cdc_version") < limit), F.lit(False)))
        return fold_events(durable(rows, "events"), keys, F.timestamp_micros(F.lit(limit)))  # looks at them twice

    def each(batch: DataFrame, batch_id: int) -> None:
        if keep is None:
            apply_to_state(state, batch, batch_id, keys, buckets, change)
            return
        if state.committed(batch_id):
            return
        moment, scale = F.col(sequence).cast("long"), 1
        if scd != 1:
            moment, scale = F.unix_micros(F.least(F.col(event_time).cast("timestamp"), F.current_timestamp())), 1_000_000
        newest = batch.agg(F.max(moment)).first()[0]
        if newest is not None:
            state.advance(batch_id, newest - keep * scale)
        limit = state.horizon(batch_id)
        if limit is None:
            apply_to_state(state, batch, batch_id, keys, buckets, change)
            return
        is_late = F.coalesce(moment < limit, F.lit(False))
        batch.filter(is_late).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        apply_to_state(state, batch.filter(~is_late), batch_id, keys, buckets, lambda old, new: fold(change(old, new), limit))

    return _start(stream, checkpoint, each, once)


def refresh_fact(
    state: PartitionedState,
    key: str,
    rows: DataFrame | Iterable[DataFrame],
    batch_id: int,
    deleted: DataFrame | None = None,
    stored: bool = False,
) -> None:
    """Merge a batch of fact rows, and the keys of deleted ones, into the stored partitions they touch.

    As ``merge_fact``, but a large table is merged some of its partitions at a time: only the keys of the batch and what
    their stored rows keep move as a whole. The rows of the first batch may come in parts. ``stored``: ``rows`` are read
    from a table already.
    """
    target = state.read()
    if target is None:
        state.write(rows, None, batch_id)
        return
    if not stored:
        rows = durable(rows, "fact")  # looked at several times below
    keys = one_row_per_key(rows.select(key), [key], keep_null=False)
    if deleted is not None:
        keys = keys.unionByName(deleted.select(key)).distinct()
    keys = durable(keys, "fact-keys")  # repeated keys fail here
    have = {c.lower() for c in rows.columns}
    kept = [c for c in target.columns if c.lower() not in have or c == "_created_date"]
    old = target.select(key, state.partition, *kept).join(keys, key, "left_semi")
    old = durable(old, "fact-old")
    moved = old.select(state.partition).unionByName(rows.select(state.partition))
    touched = touched_values(moved, state.partition)
    if not touched:
        return
    n = min(len(touched), parts_for(target.count()))
    groups = [touched[i::n] for i in range(n)]
    in_group = [_in_partitions(state.partition, g) for g in groups]
    # whatever is in no other group is in the last one
    in_group_new = [*in_group[:-1], ~reduce(Column.__or__, in_group[:-1], F.lit(False))]

    def merged(stored_rows: Column, new_rows: Column) -> DataFrame:
        rest = target.filter(stored_rows).join(old.filter(stored_rows).select(key), key, "left_anti").select(*target.columns)
        source = with_first_values(rows.filter(new_rows), old, key)
        return rest.unionByName(source, allowMissingColumns=True)

    state.write((merged(*g) for g in zip(in_group, in_group_new)), touched, batch_id)


def _in_partitions(partition: str, folders: Sequence[str]) -> Column:
    """Whether a row is in one of the folders; never null."""
    part = F.col(partition).cast("string")
    hit = F.coalesce(part.isin([v for v in folders if v != NULL_FOLDER]), F.lit(False))
    return hit | part.isNull() if NULL_FOLDER in folders else hit


def stream_quality(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    rules: Sequence[Rule],
    fail_limit: float | None = None,
    key: str | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Expectations on a stream: WARNING tags the row, SKIP_ROW and ERROR quarantine it.

    With ``fail_limit`` a batch whose share of ERROR rows is higher stops the query. Valid and quarantined rows go out
    in one pass, as two partitions of a folder per batch, so a retried batch overwrites itself.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        checked = dq_check(batch, rules)
        if fail_limit is not None:
            enforce_threshold(error_share(checked, rules, key), fail_limit)
        checked.withColumn("quarantined", (F.size(FAILED) > 0).cast("int")).write.mode("overwrite").partitionBy(
            "quarantined"
        ).parquet(f"{path}/batch={batch_id}")

    return _start(stream, checkpoint, each, once)


def read_quality(spark: SparkSession, path: str, quarantined: bool) -> DataFrame:
    """One side of the split (partition pruning reads only that side)."""
    df = spark.read.parquet(path)
    return df.filter(F.col("quarantined") == F.lit(int(quarantined))).drop("quarantined", "batch")


def stream_gold(
    stream: DataFrame,
    state: PartitionedState,
    checkpoint: str,
    key: str,
    build: Callable[[DataFrame], DataFrame],
    once: bool = True,
) -> StreamingQuery:
    """Refresh a fact from the stream: build the batch's fact rows and rewrite the partitions they touch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        if state.committed(batch_id) or batch.isEmpty():
            return
        refresh_fact(state, key, build(batch), batch_id)

    return _start(stream, checkpoint, each, once)
