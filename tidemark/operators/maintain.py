"""Aggregates that follow changes of their input without reading all of it.

Sums and counts take signed deltas: what a changed contribution gave before goes off, what it gives now comes on. A least
or greatest value follows as long as none that equals it is taken away; only groups where that happens are computed anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

ROWS = "_rows"  # number of contributions of a group
_SIDE = "_side"


def summarise(
    contributions: DataFrame, keys: Sequence[str], sums: Sequence[str], lows: Sequence[str] = (), highs: Sequence[str] = ()
) -> DataFrame:
    """The maintained table of some contributions: sums, least and greatest values, and their number as ``_rows``."""
    return contributions.groupBy(*keys).agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in sums],
        *[F.min(c).alias(c) for c in lows],
        *[F.max(c).alias(c) for c in highs],
        F.count(F.lit(1)).alias(ROWS),
    )


def maintain(
    state: DataFrame,
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    lows: Sequence[str] = (),
    highs: Sequence[str] = (),
    recompute: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``state`` (as ``summarise`` gives it) after the contributions ``before`` were replaced by ``after``.

    Both hold whole contributions, one row each; a null summand counts as zero, and groups may have null keys.
    ``recompute(groups)`` gets the keys of groups that lost their least or greatest value and returns their contributions
    as they are now; it is called only if there are such groups, and is needed with ``lows`` or ``highs``. Groups
    without contributions go. The state is grouped once with the changes; the input behind it isn't read.
    """
    if (lows or highs) and recompute is None:
        raise ValueError("least and greatest values need recompute")
    keys, sums, ends = list(keys), list(sums), [*lows, *highs]
    sides = []
    for side, name in ((state, "state"), (before, "before"), (after, "after")):
        rows = side if name == "state" else side.withColumn(ROWS, F.lit(1).cast("long"))
        sides.append(rows.select(*keys, *sums, *ends, ROWS, F.lit(name).alias(_SIDE)))
    every = sides[0].unionByName(sides[1]).unionByName(sides[2])

    def of(name: str, column: str) -> Column:
        return F.when(F.col(_SIDE) == name, F.col(column))

    aggregates: list[Column] = []
    for c in [*sums, ROWS]:
        value = F.coalesce(F.col(c), F.lit(0))
        aggregates.append(F.sum(F.when(F.col(_SIDE) == "before", -value).otherwise(value)).alias(c))
    for c in ends:
        least = F.min if c in lows else F.max
        aggregates += [least(of(name, c)).alias(f"_{name}_{c}") for name in ("state", "before", "after")]
    grouped = every.groupBy(*keys).agg(*aggregates).filter(F.col(ROWS) > 0)
    lost = F.lit(False)
    for c in ends:
        kept, gone, new = (F.col(f"_{name}_{c}") for name in ("state", "before", "after"))
        covered = (new <= kept) if c in lows else (new >= kept)
        lost = lost | F.coalesce((gone == kept) & ~F.coalesce(covered, F.lit(False)), F.lit(False))
        best = F.least if c in lows else F.greatest
        grouped = grouped.withColumn(c, best(kept, new))
    types = {f.name: f.dataType for f in state.schema.fields}
    out = grouped.select(
        *keys, *[F.col(c).cast(types[c]).alias(c) for c in [*sums, *ends, ROWS]], *([lost.alias("_lost")] if ends else [])
    )
    if not ends:
        return out
    out = durable(out, "maintained")
    groups = out.filter("_lost").select(*keys)
    if groups.isEmpty():
        return out.drop("_lost")
    fresh = summarise(recompute(groups), keys, sums, lows, highs).select(*keys, *ends)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    mended = out.filter("_lost").alias("l").join(fresh.alias("r"), same, "left")
    mended = mended.select(*[F.col(f"l.{c}") for c in [*keys, *sums]], *[F.col(f"r.{c}") for c in ends], F.col(f"l.{ROWS}"))
    return out.filter("not _lost").drop("_lost").unionByName(mended)
