"""Type 2 history (and hybrid type 1 + 2).

Version columns: ``_valid_from``, ``_valid_to`` (NULL while current), ``_is_current``, ``_version``, ``_hash_key``.
Validity is event time, never load time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import change_hash
from tidemark.operators import slices
from tidemark.operators.latest import keep_latest
from tidemark.operators.merge import one_row_per_key

VERSION_COLUMNS = ("_valid_from", "_valid_to", "_is_current", "_version", "_hash_key")


def initial_versions(source: DataFrame, tracked: Sequence[str], event_time: str) -> DataFrame:
    """First load: every row is version 1 and current."""
    return source.withColumns(
        {
            "_valid_from": F.col(event_time).cast("timestamp"),
            "_valid_to": F.lit(None).cast("timestamp"),
            "_is_current": F.lit(True),
            "_version": F.lit(1),
            "_hash_key": change_hash(*tracked),
        }
    )


def _after(moment: Column, start: Column) -> Column:
    """Whether a known moment lies after ``start``; a version without a start began before everything."""
    return moment.isNotNull() & F.coalesce(moment > start, F.lit(True))


def scd2(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    event_time: str,
    overwrite: Sequence[str] = (),
    check_unique: bool = True,
) -> DataFrame:
    """Merge one change per key into a type 2 table.

    * no current row: insert version 1
    * tracked columns equal (null-safe): keep the row
    * tracked columns differ: close the current row at the event time and add the next version
    * event time null, or not after the current ``_valid_from``: ignored (see :func:`late_changes`)
    * a null key: ignored, also on the first load

    ``overwrite`` columns are type 1: the incoming value replaces the old one on every version of the key, unless the
    event is older than the current version. Applying the same batch twice gives the same table. Closed history takes
    part in no join unless there are type 1 columns.
    """
    keys = list(keys)
    source = source.dropna(subset=keys)
    if check_unique:
        source = one_row_per_key(source, keys, keep_null=False)
    incoming = initial_versions(source, tracked, event_time)
    if target is None:
        return incoming

    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    is_current = F.coalesce("_is_current", F.lit(False))
    current, history = target.filter(is_current), target.filter(~is_current)

    t = current.withColumn("_in", F.lit(True)).alias("t")
    s = incoming.withColumn("_in", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer")

    in_t, in_s = F.col("t._in").isNotNull(), F.col("s._in").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    newer = _after(F.col("s._valid_from"), F.col("t._valid_from"))
    changed = in_t & in_s & ~same & newer
    fresh_values = in_s & (newer | F.coalesce(F.col("s._valid_from") == F.col("t._valid_from"), F.lit(False)))

    def pick(name: str, source_value: Column) -> Column:
        return source_value.cast(types[name]).alias(name)

    incoming_names = set(incoming.columns)

    def old_row() -> Column:
        fields = []
        for c in columns:
            value = F.col(f"t.{c}")
            if c == "_valid_to":
                value = F.when(changed, F.col("s._valid_from")).otherwise(value)
            elif c == "_is_current":
                value = ~changed
            elif c in overwrite and c in incoming_names:
                value = F.when(fresh_values, F.col(f"s.{c}")).otherwise(value)
            fields.append(pick(c, value))
        return F.struct(*fields)

    def new_row() -> Column:
        fields = []
        for c in columns:
            if c == "_version":
                value = F.coalesce(F.col("t._version"), F.lit(0)) + 1
            elif c in incoming_names:
                value = F.col(f"s.{c}")
            else:
                value = F.lit(None)
            fields.append(pick(c, value))
        return F.struct(*fields)

    # one pass over the join: a row gives its old version, its new version, or both
    rows = F.array_compact(F.array(F.when(in_t, old_row()), F.when(changed | ~in_t, new_row())))
    merged = joined.select(F.explode(rows).alias("r")).select("r.*")

    if overwrite:
        since = current.select(*keys, F.col("_valid_from").alias("_since"))
        fresh = incoming.join(since, keys, "left").filter(
            _after(F.col("_valid_from"), F.col("_since")) | F.coalesce(F.col("_valid_from") == F.col("_since"), F.lit(False))
        )
        fresh = fresh.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*overwrite).alias("_new"))
        match = [F.col(k) == F.col(f"_k_{k}") for k in keys]
        history = history.join(fresh, match, "left").select(
            *[
                F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).cast(types[c]).alias(c)
                if c in overwrite
                else F.col(c)
                for c in columns
            ]
        )
    return history.select(*columns).unionByName(merged)


def late_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], tracked: Sequence[str], event_time: str
) -> DataFrame:
    """Changes that :func:`scd2` ignores: tracked values differ but the event is not after the current version.

    That includes events without a time.
    """
    keys = list(keys)
    t = target.filter(F.col("_is_current")).select(
        *keys, *[F.col(c).alias(f"_cur_{c}") for c in tracked], F.col("_valid_from").alias("_cur_from")
    )
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_cur_{c}"))
    late = ~_after(F.col(event_time).cast("timestamp"), F.col("_cur_from"))
    return source.join(t, keys).filter(differs & late).select(*source.columns)


def chain_versions(
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    event_time: str,
    tie: Sequence[str] = (),
    deleted: Column | None = None,
    keep_events: bool = False,
) -> DataFrame:
    """Type 2 table from a feed with any number of changes per key.

    Consecutive rows with equal tracked values (compared null-safe, column by column) collapse into the first; each version
    ends where the next begins. Rows for which ``deleted`` holds end the version before them and start none.
    The windows run per key and day, so a key with a large share of all changes is spread over its days; one row per
    key and day carries the last state, the version count and the next start across the borders. Of several changes at
    one instant the last (by ``tie``) counts.

    With ``keep_events`` the repeats and deletes stay, with ``_shown`` false: a later feed can be chained with them
    (:func:`shown_versions` leaves them out).
    """
    keys = list(keys)
    events = changes.withColumn("_valid_from", F.col(event_time).cast("timestamp")).filter(
        F.col("_valid_from").isNotNull()
    )
    events = events.withColumn("_gone", F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False)))
    events = events.withColumn("_hash_key", change_hash(*tracked))
    events = keep_latest(events, [*keys, "_valid_from"], [*tie, "_hash_key"])
    state = F.struct(F.col("_gone").alias("gone"), *[F.when(~F.col("_gone"), F.col(c)).alias(f"v{i}") for i, c in enumerate(tracked)])
    events = slices.with_slice(events.withColumn("_state", state), slices.day_slice("_valid_from"))

    # inside a slice: compare each event with the one before it
    part = [*keys, slices.SLICE]
    by_time = Window.partitionBy(*part).orderBy("_valid_from")
    marked = events.withColumn("_before", F.lag("_state").over(by_time))
    inner = F.col("_before").isNotNull() & ~F.col("_before").eqNullSafe(F.col("_state"))

    # one row per slice; only these move to the key to be carried across slice borders
    ends = marked.groupBy(*part).agg(
        F.min("_valid_from").alias("_first"),
        F.min_by("_state", "_valid_from").alias("_first_state"),
        F.max_by("_state", "_valid_from").alias("_last_state"),
        F.count_if(inner & ~F.col("_gone")).alias("_inner"),
        F.min(F.when(inner, F.col("_valid_from"))).alias("_first_inner"),
    )
    by_slice = Window.partitionBy(*keys).orderBy(slices.SLICE)
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc(slices.SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carried", F.lag("_last_state").over(by_slice))
    opens = F.col("_carried").isNull() | ~F.col("_carried").eqNullSafe(F.col("_first_state"))
    ends = ends.withColumn("_opens", opens).withColumn("_start", F.when(opens, F.col("_first")).otherwise(F.col("_first_inner")))
    versions = F.col("_inner") + (F.col("_opens") & ~F.col("_first_state.gone")).cast("long")
    ends = ends.select(
        *part,
        "_opens",
        F.coalesce(F.sum(versions).over(earlier), F.lit(0)).alias("_versions_before"),
        F.last("_start", ignorenulls=True).over(later).alias("_next_start"),
    )
    starts = inner | (F.col("_before").isNull() & F.col("_opens"))
    rows = marked.join(ends, part).withColumn("_starts", starts).withColumn("_shown", starts & ~F.col("_gone"))
    if not keep_events:
        rows = rows.filter("_starts")
    back = Window.partitionBy(*part).orderBy(F.desc("_valid_from")).rowsBetween(Window.unboundedPreceding, -1)
    upto = by_time.rowsBetween(Window.unboundedPreceding, 0)
    shown = F.col("_shown")
    following = F.last(F.when(F.col("_starts"), F.col("_valid_from")), ignorenulls=True).over(back)
    number = F.col("_versions_before") + F.sum(shown.cast("long")).over(upto)
    rows = rows.withColumns({"_version": number.cast("int"), "_valid_to": F.coalesce(following, F.col("_next_start"))})
    rows = rows.withColumns(
        {
            "_is_current": shown & F.col("_valid_to").isNull(),
            "_valid_to": F.when(shown, F.col("_valid_to")),
            "_version": F.when(shown, F.col("_version")),
        }
    ).drop(slices.SLICE, "_state", "_before", "_opens", "_versions_before", "_next_start", "_starts")
    return rows.withColumn("_folded", F.lit(False)) if keep_events else shown_versions(rows)


def shown_versions(events: DataFrame) -> DataFrame:
    """The versions of a table that :func:`scd2_feed` keeps."""
    return events.filter("_shown").drop("_shown", "_gone", "_folded")


def fold_events(events: DataFrame, keys: Sequence[str], horizon: Column) -> DataFrame:
    """A table that :func:`scd2_feed` keeps, without the hidden events before ``horizon``.

    Nothing earlier than the horizon may arrive any more. A repeat can't become a version then and goes; so does a delete,
    whose moment stays as the end of its version (``_folded``), from which :func:`scd2_feed` makes the event again when the
    key changes later. Versions, and every later event, stay: the history is the same as if nothing had been folded.
    """
    keys = list(keys)
    events = events.withColumn("_old", F.coalesce(F.col("_valid_from") < horizon, F.lit(False)))
    ends = events.filter("_old AND _gone").select(*keys, F.col("_valid_from").alias("_valid_to"), F.lit(True).alias("_deleted"))
    kept = events.filter("_shown OR NOT _old").join(ends, [*keys, "_valid_to"], "left")
    kept = kept.withColumn("_folded", F.col("_folded") | F.coalesce("_deleted", F.lit(False)))
    return kept.select(*[c for c in events.columns if c != "_old"])


def scd2_feed(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    event_time: str,
    tie: Sequence[str] = (),
    deleted: Column | None = None,
) -> DataFrame:
    """Merge a feed with several changes per key, late ones included.

    The table keeps every event, those that repeat a state or delete the key with ``_shown`` false, so the result depends
    on the events alone and not on the order in which they arrive; :func:`shown_versions` gives the versions. History is
    rebuilt for the keys in the feed only. All other keys stay as they are.
    """
    keys = list(keys)
    changes = changes.dropna(subset=keys)
    if target is None:
        return chain_versions(changes, keys, tracked, event_time, tie, deleted, keep_events=True)
    ids = changes.select(*keys).distinct()
    columns = target.columns
    stored = target.join(ids, keys, "left_semi").withColumn("_incoming", F.lit(0))
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    incoming = changes.withColumns(
        {"_valid_from": F.col(event_time).cast("timestamp"), "_gone": gone, "_incoming": F.lit(1)}
    )
    # deletes that have been folded into the end of their version; an event at the same moment counts before them
    ends = stored.filter("_folded").select(
        *keys, F.col("_valid_to").alias("_valid_from"), F.lit(True).alias("_gone"), F.lit(-1).alias("_incoming")
    )
    known = stored.drop("_valid_to", "_is_current", "_version", "_hash_key", "_shown", "_folded")
    rebuilt = chain_versions(
        known.unionByName(ends, allowMissingColumns=True).unionByName(incoming, allowMissingColumns=True),
        keys,
        tracked,
        "_valid_from",
        [*tie, "_incoming"],
        F.col("_gone"),
        keep_events=True,
    )
    untouched = target.join(ids, keys, "left_anti")
    return untouched.unionByName(rebuilt.select(*columns))
