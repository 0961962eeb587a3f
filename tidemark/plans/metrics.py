"""Declared measures and metrics over the star schema.

Every model is aggregated to the grain of the question before anything is joined, so a join never multiplies
rows of a measure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keys import assign_keys

_AGGREGATES = {"sum": F.sum, "count_distinct": F.countDistinct, "min": F.min, "max": F.max, "avg": F.avg}


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    expr: str


@dataclass(frozen=True)
class Model:
    """A table with named entities (join keys), dimensions and measures; each maps a name to a SQL expression."""

    name: str
    table: str
    entities: Mapping[str, str] = field(default_factory=dict)
    dimensions: Mapping[str, str] = field(default_factory=dict)
    measures: Sequence[Measure] = ()

    def column(self, name: str) -> str | None:
        return self.dimensions.get(name) or self.entities.get(name)


@dataclass(frozen=True)
class Metric:
    """``ratio``: numerator / denominator. ``derived``: an expression over measures. Both divide safely."""

    name: str
    measures: tuple[str, ...]
    expr: str


def ratio(name: str, numerator: str, denominator: str) -> Metric:
    return Metric(name, (numerator, denominator), f"try_divide({numerator}, {denominator})")


def derived(name: str, expr: str, *measures: str) -> Metric:
    return Metric(name, measures, expr)


# The published models and metrics.
MODELS = {
    "sales": Model(
        "sales",
        "fact_sales",
        entities={"order_line": "line_id", "order": "order_id", "customer": "dim_customer_key",
                  "campaign": "dim_campaign_key", "product": "dim_product_key", "location": "dim_location_key"},
        dimensions={"order_date": "to_date(cast(dim_date_key as string), 'yyyyMMdd')",
                    "year_month": "order_year_month", "order_status": "order_status"},
        measures=(
            Measure("total_sales_amount", "sum", "line_total"),
            Measure("order_count", "count_distinct", "order_id"),
            Measure("first_order_date", "min", "to_date(cast(dim_date_key as string), 'yyyyMMdd')"),
            Measure("last_order_date", "max", "to_date(cast(dim_date_key as string), 'yyyyMMdd')"),
        ),
    ),
    "campaigns": Model(
        "campaigns",
        "campaign_costs",
        entities={"campaign": "dim_campaign_key"},
        dimensions={"campaign_name": "campaign_name", "channel": "channel"},
        measures=(
            Measure("campaign_acquisition_cost", "max", "acquisition_cost"),
            Measure("total_spend", "sum", "total_spend"),
            Measure("customers_acquired", "sum", "customers_acquired"),
        ),
    ),
    "locations": Model(
        "locations",
        "dim_location",
        entities={"location": "dim_location_key"},
        dimensions={"city_tier": "city_tier", "state": "state"},
    ),
}

METRICS = {
    m.name: m
    for m in (
        derived("orders", "order_count", "order_count"),
        ratio("average_order_value", "total_sales_amount", "order_count"),
        ratio("customer_acquisition_cost", "total_spend", "customers_acquired"),
        derived(
            "purchase_frequency",
            "try_divide(order_count * 30, datediff(last_order_date, first_order_date))",
            "order_count", "first_order_date", "last_order_date",
        ),
        derived(
            "customer_lifetime_value",
            "total_sales_amount - coalesce(campaign_acquisition_cost, 0)",
            "total_sales_amount", "campaign_acquisition_cost",
        ),
        derived(
            "tenure_frequency",
            "try_divide(order_count, timestampdiff(MONTH, first_order_date, as_of))",
            "order_count", "first_order_date",
        ),
    )
}


def campaign_costs(dim_campaign: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign members with spend, acquired customers and cost per customer (0 for organic)."""
    spend = campaigns.groupBy("campaign_id").agg(
        F.max("total_spend").alias("total_spend"), F.max("customers_acquired").alias("customers_acquired")
    )
    wide = dim_campaign.select("dim_campaign_key", "campaign_id", "campaign_name", "channel").join(
        spend, "campaign_id", "left"
    )
    cost = F.when(F.upper("channel") == "ORGANIC", F.lit(0)).otherwise(
        F.try_divide("total_spend", "customers_acquired")
    )
    return wide.withColumn("acquisition_cost", cost.cast("decimal(15,2)"))


def _aggregate(table: DataFrame, model: Model, names: Sequence[str], by: Sequence[str], where: str | None):
    rows = table.filter(where) if where else table
    keys = [F.expr(model.column(b)).alias(b) for b in by]
    measures = {m.name: m for m in model.measures}
    exprs = [_AGGREGATES[measures[n].agg](F.expr(measures[n].expr)).alias(n) for n in names]
    return rows.groupBy(*keys).agg(*exprs)


def _path(models: Mapping[str, Model], start: str, goal: str, usable) -> list[tuple[str, str]]:
    """The shortest way from one model to another: (shared entity, model it leads to) for each step."""
    ways, seen = [[(None, start)]], {start}
    for way in ways:
        here = way[-1][1]
        if here == goal:
            return way[1:]
        for name, model in models.items():
            shared = next((e for e in model.entities if e in models[here].entities), None)
            if shared and name not in seen and (name == goal or usable(name)):
                seen.add(name)
                ways.append([*way, (shared, name)])
    raise ValueError(f"no entities lead from {start} to {goal}")


def _distinct_counts(groups: DataFrame, rows: DataFrame, entity: str, exprs: Mapping[str, str], group_by: Sequence[str]):
    """Exact distinct counts per group over values that several entities, and several groups, may share.

    Values get dense ranks, a group holds one bitmap for each 32,768 ranks it meets, and bitmaps are united in the map
    tasks, so that a group with most of the values is never one list. ``groups``: group columns and the entity.
    """
    parts = []
    for name, expr in exprs.items():
        values = rows.select(entity, F.expr(expr).alias("_v")).dropna().distinct()
        ranked = assign_keys(values.select("_v").distinct().withColumn("_number", F.lit(None).cast("long")), "_v", "_number")
        met = groups.join(values.join(ranked, "_v").select(entity, "_number"), entity)
        bits = met.groupBy(*group_by, F.bitmap_bucket_number("_number").alias("_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_bits")
        )
        parts.append(bits.select(*group_by, F.lit(name).alias("_name"), F.bitmap_count("_bits").alias("_n")))
    counts = (F.sum(F.when(F.col("_name") == n, F.col("_n")).otherwise(0)).alias(n) for n in exprs)
    return reduce(DataFrame.unionByName, parts).groupBy(*group_by).agg(*counts)


def _beside(left: DataFrame, right: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Both sides' columns per group; a group may stand on one side only, and null is a group like any other."""
    if not group_by:  # each side is one row
        return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
    a, b = left.alias("l"), right.alias("r")
    same = reduce(lambda x, y: x & y, (F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group_by))
    return a.join(b, same, "full_outer").select(
        *[F.coalesce(f"l.{g}", f"r.{g}").alias(g) for g in group_by],
        *[F.col(f"l.{c}") for c in left.columns if c not in group_by],
        *[F.col(f"r.{c}") for c in right.columns if c not in group_by],
    )


def query_metrics(
    tables: Mapping[str, DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str],
    where: Mapping[str, str] | None = None,
    models: Mapping[str, Model] = MODELS,
    params: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Metrics at the grain of ``group_by``.

    A model that has all grouping columns is grouped by them. One that has not is reached through entities, over further
    models where it takes them, from the first model that has: the distinct (group, entity) pairs of the way are joined
    to its rows. Sums, least and greatest values are aggregated per entity before and with the same function after;
    distinct counts are counted anew over the values that a group meets.
    """
    group_by = list(group_by)
    where = where or {}
    wanted: dict[str, list[str]] = {}
    for metric in metrics:
        for name in METRICS[metric].measures:
            owner = next(m for m in models.values() if any(x.name == name for x in m.measures))
            names = wanted.setdefault(owner.name, [])
            if name not in names:
                names.append(name)

    def has_all(name: str) -> bool:
        return all(models[name].column(g) for g in group_by)

    def rows_of(name: str) -> DataFrame:
        rows = tables[models[name].table]
        return rows.filter(where[name]) if where.get(name) else rows

    direct = [n for n in wanted if has_all(n)]
    base = next((n for n in [*direct, *models] if has_all(n) and models[n].table in tables), None)
    if base is None:
        raise ValueError(f"no model can be grouped by {group_by}")

    out = None
    for name in direct + [n for n in wanted if n not in direct]:
        model = models[name]
        if name in direct:
            part = _aggregate(rows_of(name), model, wanted[name], group_by, None)
        else:
            groups, here = rows_of(base), base
            keys = [F.expr(models[base].column(g)).alias(f"_g{i}") for i, g in enumerate(group_by)]
            held = [f"_g{i}" for i in range(len(group_by))]
            for entity, step in _path(models, base, name, lambda n: models[n].table in tables):
                over = F.expr(models[here].entities[entity]).alias("_e")
                if here == base:
                    groups = groups.select(*keys, over).distinct()
                else:
                    links = rows_of(here).select(F.expr(models[here].entities[last]).alias("_from"), over).distinct()
                    groups = groups.withColumnRenamed("_e", "_from").join(links, "_from").select(*held, "_e").distinct()
                last, here = entity, step
            measures = {m.name: m for m in model.measures}
            distinct = {n: measures[n].expr for n in wanted[name] if measures[n].agg == "count_distinct"}
            again = [n for n in wanted[name] if n not in distinct]
            if any(measures[n].agg not in ("sum", "min", "max") for n in again):
                raise ValueError(f"{again} cannot be aggregated a second time")
            rows = rows_of(name).withColumn("_e", F.expr(model.entities[last]))
            once = rows.groupBy("_e").agg(*[_AGGREGATES[measures[n].agg](F.expr(measures[n].expr)).alias(n) for n in again], F.lit(1).alias("_"))
            part = groups.join(once, "_e").groupBy(*held).agg(*[_AGGREGATES[measures[n].agg](n).alias(n) for n in again], F.lit(1).alias("_"))
            if distinct:
                counted = _distinct_counts(groups, rows, "_e", distinct, held)
                part = _beside(part, counted, held).fillna(0, list(distinct))
            part = part.select(*[F.col(h).alias(g) for h, g in zip(held, group_by)], *wanted[name])
        out = part if out is None else _beside(out, part, group_by)
    for name, value in (params or {}).items():
        out = out.withColumn(name, value)
    return out.select(*group_by, *[F.expr(METRICS[m].expr).alias(m) for m in metrics])
