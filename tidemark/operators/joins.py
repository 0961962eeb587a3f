"""Joins that hold up under hot keys: point-in-time lookup, salted lookup."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import FAR_FUTURE
from tidemark.operators import slices

SALT = "_salt"


def key_sketch(df: DataFrame, key: str, share: float = 0.005, by: Sequence[str] = ()) -> DataFrame:
    """(by..., sketch, n): a frequent-items sketch of the non-null keys and their number, made in the map tasks.

    Only sketches of fixed size are shuffled, however many keys there are. Kept in a table, one row per batch, they answer
    ``sketched_keys`` without a look at the rows.
    """
    # a sketch of t items is wrong by less than 2.7 / t of the rows, and lists what has more than twice that
    tracked = math.ceil(8 / share)
    made = F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch")
    return df.filter(F.col(key).isNotNull()).groupBy(*by).agg(made, F.count(F.lit(1)).alias("n"))


def sketched_keys(sketches: DataFrame, share: float = 0.005) -> list:
    """All keys with more than ``share`` of the rows behind ``sketches`` (of one key, made for this share), in ascending order.

    A key with a little less than the share may be among them; for salting that does no harm. None is missing.
    """
    limit = math.ceil(4 / share)  # the listed keys have at least a quarter of the share each
    # grouped, so that no sketches at all give no row instead of an error
    merged = sketches.groupBy(F.col("n").isNull()).agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"), F.sum("n").alias("n"))
    found = merged.select("n", F.inline(F.expr(f"approx_top_k_estimate(sketch, {limit})")))
    return sorted(r[0] for r in found.filter(F.col("count") > F.col("n") * share).select("item").collect())


def hot_keys(df: DataFrame, key: str, share: float = 0.005) -> list:
    """Key values that each hold more than ``share`` of the non-null rows, in ascending order.

    A sketch proposes them and their rows are counted; no other key is shuffled. At most ``1 / share`` values can qualify,
    so the list on the driver is bounded whatever the table size.
    """
    sketch = key_sketch(df, key, share)
    total = F.sum(F.when(F.col(key).isNotNull(), 1))
    proposed = sketched_keys(sketch, share)
    if not proposed:
        return []
    known = F.col(key).isin(proposed)
    counts = df.groupBy(F.when(known, F.col(key)).alias("_key")).agg(total.alias("_n")).collect()
    rows = sum(r["_n"] or 0 for r in counts)
    return sorted(r["_key"] for r in counts if r["_key"] is not None and r["_n"] > rows * share)


def salted_lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    hot: Sequence,
    how: str = "inner",
    salts: int = 64,
) -> DataFrame:
    """Join ``left`` to a ``right`` with unique keys, spreading the given hot keys over ``salts`` partitions.

    Rows of a hot key take a salt from their own hash, and the right row of that key is repeated once per salt
    (at most ``len(hot) * salts`` extra rows). Null keys never match, so they are spread the same way. Every other
    key has salt 0. The result is the same as the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    is_hot = F.col(key).isin(list(hot)) if hot else F.lit(False)
    salted = left.withColumn(SALT, F.when(F.col(key).isNull() | is_hot, spread).otherwise(F.lit(0)))
    if hot:
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        repeated = right.withColumn(SALT, F.explode(copies))
    else:
        repeated = right.withColumn(SALT, F.lit(0))
    return salted.join(repeated, [key, SALT], how).drop(SALT)


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    attributes: dict[str, Column | str],
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
    versions_per_key: int | None = None,
) -> DataFrame:
    """Left point-in-time lookup: the version that started last, if it still holds at the moment.

    A version holds while ``valid_from <= at < coalesce(valid_to, far future)``, and no longer than until the next one
    of its key starts. A fact therefore finds one version at most, however versions overlap; of several that start at
    one instant the greatest (by end, then attributes) counts.

    ``versions_per_key`` is a bound the caller has measured. With a small one (up to 64) an equi join with the
    range as residual predicate is used. Without it, a key with many facts *and* many versions would make that
    join quadratic, so the lookup is solved on the distinct (key, time) pairs by a sliced look-behind, which is
    linear, and the facts pick the answer up with one equi join on (key, time). Both give the same rows.
    """
    attrs = {name: (F.col(c) if isinstance(c, str) else c) for name, c in attributes.items()}
    open_end = F.coalesce(F.col(valid_to), F.lit(FAR_FUTURE).cast("timestamp"))
    versions = (
        versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
        .groupBy(F.col(key).alias("_k"), F.col(valid_from).alias("_t"))
        .agg(F.max(F.struct(open_end.alias("_to"), *[c.alias(n) for n, c in attrs.items()])).alias("_version"))
    )
    if versions_per_key is not None and versions_per_key <= 64:
        following = F.lead("_t").over(Window.partitionBy("_k").orderBy("_t"))
        v = versions.withColumn("_next", F.least("_version._to", following)).select(
            "_k", "_t", "_next", *[F.col(f"_version.{n}").alias(n) for n in attrs]
        )
        hit = (F.col(key) == F.col("_k")) & (F.col(at) >= F.col("_t")) & (F.col(at) < F.col("_next"))
        return facts.join(v, hit, "left").drop("_k", "_t", "_next")

    moments = facts.select(F.col(key).alias("_k"), F.col(at).alias("_t")).dropna().distinct()
    starts = versions.withColumn("_kind", F.lit(0))
    timeline = starts.unionByName(moments.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    timeline = slices.with_slice(timeline, slices.day_slice("_t"))
    found = slices.previous_value(timeline, ["_k"], ["_t", "_kind"], "_version", "_hit")
    answers = found.filter((F.col("_kind") == 1) & (F.col("_t") < F.col("_hit._to"))).select(
        F.col("_k").alias(key), F.col("_t").alias(at), *[F.col(f"_hit.{n}").alias(n) for n in attrs]
    )
    return facts.join(answers, [key, at], "left")


def lookup(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, value: str, default: int, hot: Sequence = ()
) -> DataFrame:
    """Left lookup of one dimension value with a default member. ``dim_key`` must be unique in ``dim``."""
    side = dim.select(F.col(dim_key).alias(fact_key), F.col(value).alias("_found"))
    joined = salted_lookup(facts, side, fact_key, hot, "left")
    return joined.withColumn(value, F.coalesce("_found", F.lit(default).cast("long"))).drop("_found")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows with no parent (a null key counts as no parent)."""
    ids = parent.select(F.col(parent_key or key).alias("_pk"))
    return child.join(ids, F.col(key) == F.col("_pk"), "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose parent exists."""
    ids = parent.select(F.col(parent_key or key).alias("_pk"))
    return child.join(ids, F.col(key) == F.col("_pk"), "left_semi")
