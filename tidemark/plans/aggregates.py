"""Gold aggregates and customer metrics.

Facts are reduced to the aggregate's grain first; dimension attributes join afterwards, on the small side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import (
    ORGANIC_KEY,
    UNKNOWN_KEY,
    lifespan_days,
    lifespan_months,
    safe_div,
    span_frequency,
)
from tidemark.operators.joins import salted_lookup
from tidemark.operators.maintain import ROWS, maintain, summarise

CAMPAIGN_GROUP, CAMPAIGN_SUMS = ("year_month", "dim_campaign_key"), ("total_revenue", "total_orders")
# keys, sums, least and greatest values of the customer measures
CUSTOMER_SUMMARY = (
    ("dim_customer_key",), ("lifetime_revenue", "total_orders", "total_items_purchased"), ("first_order_date",),
    ("last_order_date",),
)


def campaign_orders(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """What each order gives to a month and campaign: its revenue, and one order if it has a number."""
    months = dim_date.select("dim_date_key", (F.col("year") * 100 + F.col("month_number")).alias("year_month"))
    # lines are reduced to orders of a day before the calendar joins; a day it lacks keeps the month of its key
    daily = (
        fact.groupBy("dim_date_key", "dim_campaign_key", "order_number")
        .agg(F.sum("line_total").alias("line_total"))
        .join(months, "dim_date_key", "left")
        .withColumn("year_month", F.coalesce("year_month", F.when(F.col("dim_date_key") > 0, F.expr("dim_date_key div 100")).cast("int")))
    )
    return daily.groupBy("year_month", "dim_campaign_key", "order_number").agg(
        F.sum("line_total").alias("total_revenue"),
        F.max(F.col("order_number").isNotNull().cast("long")).alias("total_orders"),
    )


def campaign_measures(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Month and campaign: revenue and orders, in the form that ``follow_campaigns`` maintains."""
    summary = summarise(campaign_orders(fact, dim_date), CAMPAIGN_GROUP, CAMPAIGN_SUMS)
    return summary.withColumn("total_revenue", F.col("total_revenue").cast("decimal(25,2)"))


def follow_campaigns(state: DataFrame, before: DataFrame, after: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``campaign_measures`` after the sales facts ``before`` became ``after`` (all rows of the touched order numbers)."""
    sides = (campaign_orders(side, dim_date) for side in (before, after))
    return maintain(state, *sides, CAMPAIGN_GROUP, CAMPAIGN_SUMS)


def campaign_roi(fact: DataFrame, dim_date: DataFrame, dim_campaign: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Month and campaign: revenue, orders, spend, acquisition cost (0 for organic), return on ad spend."""
    return finish_campaign_roi(campaign_measures(fact, dim_date), dim_campaign, campaigns)


def finish_campaign_roi(measures: DataFrame, dim_campaign: DataFrame, campaigns: DataFrame) -> DataFrame:
    spend = campaigns.groupBy("campaign_id").agg(
        F.max("total_spend").alias("total_spend"), F.max("customers_acquired").alias("customers_acquired")
    )
    names = dim_campaign.select("dim_campaign_key", "campaign_id", "campaign_name", "channel")
    wide = measures.join(names, "dim_campaign_key").join(spend, "campaign_id", "left")
    return wide.select(
        "year_month",
        "dim_campaign_key",
        "campaign_name",
        "channel",
        "total_revenue",
        "total_orders",
        "total_spend",
        "customers_acquired",
        F.when(F.upper("channel") == "ORGANIC", F.lit(0).cast("decimal(15,2)"))
        .otherwise(safe_div("total_spend", "customers_acquired").cast("decimal(15,2)"))
        .alias("customer_acquisition_cost"),
        safe_div("total_revenue", "total_spend").alias("return_on_ad_spend"),
    )


def campaign_cac(campaigns: DataFrame, by: Sequence[str] = ("channel",)) -> DataFrame:
    """Rolled-up acquisition cost: sum of spend over sum of acquired customers; 0 for organic."""
    total = campaigns.groupBy(*by).agg(
        F.sum("total_spend").alias("total_spend"), F.sum("customers_acquired").alias("customers_acquired")
    )
    cost = safe_div("total_spend", "customers_acquired")
    if "channel" in by:
        cost = F.when(F.upper("channel") == "ORGANIC", F.lit(0).cast("decimal(15,2)")).otherwise(cost)
    return total.withColumn("customer_acquisition_cost", cost)


def _orders(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Facts at (customer key, order) grain, so that orders are counted later without a distinct.

    Partial sums are formed on the map side, and a customer with very many lines is spread over its orders.
    """
    orders = fact.groupBy("dim_customer_key", "order_number").agg(
        F.sum("line_total").alias("line_total"),
        F.sum("quantity").alias("quantity"),
        F.min("dim_date_key").alias("_first"),
        F.max("dim_date_key").alias("_last"),
    )
    # a day the calendar lacks is read from its key, so no order is lost
    for key, name in (("_first", "first_date"), ("_last", "last_date")):
        days = dim_date.select(F.col("dim_date_key").alias(key), F.col("full_date").alias(name))
        spelled = F.try_to_timestamp(F.col(key).cast("string"), F.lit("yyyyMMdd")).cast("date")
        orders = orders.join(days, key, "left").withColumn(name, F.coalesce(name, spelled))
    return orders.drop("_first", "_last")


def _customer_measures(order_count: Column) -> list[Column]:
    return [
        F.sum("line_total").alias("lifetime_revenue"),
        order_count.alias("total_orders"),
        F.sum("quantity").alias("total_items_purchased"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
    ]


def _customer_kpis(df: DataFrame, end: Column) -> DataFrame:
    return df.withColumns(
        {
            "average_order_value": safe_div("lifetime_revenue", "total_orders"),
            "purchase_frequency": span_frequency("total_orders", "first_order_date", "last_order_date"),
            "customer_lifespan_days": lifespan_days(end, F.col("registration_date").cast("date")),
        }
    )


def _customer_orders(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """What each order gives to a customer version."""
    return _orders(fact, dim_date).select(
        "dim_customer_key",
        F.col("line_total").alias("lifetime_revenue"),
        F.col("order_number").isNotNull().cast("long").alias("total_orders"),
        F.col("quantity").alias("total_items_purchased"),
        F.col("first_date").alias("first_order_date"),
        F.col("last_date").alias("last_order_date"),
    )


def customer_measures(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Customer version: revenue, orders, items, first and last day, in the form that ``follow_customers`` maintains."""
    return summarise(_customer_orders(fact, dim_date), *CUSTOMER_SUMMARY)


def follow_customers(
    state: DataFrame, before: DataFrame, after: DataFrame, fact: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """``customer_measures`` after the sales facts ``before`` became ``after`` (all rows of the touched order numbers).

    ``fact`` is the whole new table; it is read only for customers that lost their first or last day.
    """

    def whole(groups: DataFrame) -> DataFrame:
        return _customer_orders(fact.join(groups, "dim_customer_key", "left_semi"), dim_date)

    sides = (_customer_orders(side, dim_date) for side in (before, after))
    return maintain(state, *sides, *CUSTOMER_SUMMARY, recompute=whole)


def customer_clv(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Metrics per customer version."""
    return finish_customer_clv(customer_measures(fact, dim_date), dim_customer)


def finish_customer_clv(measures: DataFrame, dim_customer: DataFrame) -> DataFrame:
    names = dim_customer.select("dim_customer_key", "customer_id", "status", "_valid_from", "registration_date")
    churned = F.when(F.col("status") == "CHURNED", F.col("_valid_from").cast("date"))
    wide = measures.drop(ROWS).join(names, "dim_customer_key")
    wide = _customer_kpis(wide, F.coalesce(churned, F.col("last_order_date")))
    return wide.drop("_valid_from", "registration_date")


def touched_facts(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """All rows of some order numbers (null is one): whole contributions to both aggregates above."""
    wanted = numbers.select(F.col("order_number").alias("_number")).distinct()
    return fact.join(wanted, F.col("order_number").eqNullSafe(F.col("_number")), "left_semi")


def churn_dates(dim_customer: DataFrame) -> DataFrame:
    """First time each customer became CHURNED."""
    return (
        dim_customer.filter(F.col("status") == "CHURNED")
        .groupBy("customer_id")
        .agg(F.min("_valid_from").cast("date").alias("churn_date"))
    )


def customer_clv_by_customer(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Metrics per natural customer: status of the current version, churn date of the first churned version."""
    owner = dim_customer.select("dim_customer_key", "customer_id")
    # an order number could appear under two versions of a customer, hence the distinct
    measures = _customer_measures(F.countDistinct("order_number"))
    per_customer = _orders(fact, dim_date).join(owner, "dim_customer_key").groupBy("customer_id").agg(*measures)
    now = dim_customer.filter("_is_current").select("customer_id", "status", "registration_date")
    wide = per_customer.join(now, "customer_id").join(churn_dates(dim_customer), "customer_id", "left")
    wide = _customer_kpis(wide, F.coalesce("churn_date", "last_order_date"))
    return wide.withColumn("lifespan_months", lifespan_months("last_order_date", "registration_date", "churn_date"))


def clv(metrics: DataFrame, cac: DataFrame, customers: DataFrame) -> DataFrame:
    """Composite lifetime value: order value x orders per 30 days x lifespan in 30-day units - acquisition cost.

    ``customers`` lists every customer: those without orders form the segment ``New`` and have no historical value.
    ``cac`` has one row per customer (customer_id, customer_acquisition_cost).
    """
    wide = customers.select("customer_id").join(metrics, "customer_id", "left").join(cac, "customer_id", "left")
    has_orders = F.coalesce(F.col("total_orders"), F.lit(0)) >= 1
    # double from here on: the product of three ratios has no natural decimal scale
    revenue, orders = F.col("lifetime_revenue").cast("double"), F.col("total_orders").cast("double")
    months = F.col("customer_lifespan_days").cast("double") / F.lit(30.0).cast("double")
    frequency = F.coalesce(F.col("purchase_frequency"), F.lit(0)).cast("double")
    gross = F.try_divide(revenue, orders) * frequency * months
    cost = F.coalesce(F.col("customer_acquisition_cost"), F.lit(0)).cast("double")
    return wide.select(
        "customer_id",
        F.when(has_orders, F.lit("Existing")).otherwise(F.lit("New")).alias("segment"),
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.when(has_orders, gross - cost).alias("customer_lifetime_value"),
        F.when(has_orders, revenue - cost).alias("net_lifetime_value"),
    )


def customer_cac(attribution: DataFrame, dim_campaign: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Acquisition cost of each customer: that of the campaign that brought them, 0 without one."""
    cost = campaigns.groupBy("campaign_id").agg(
        safe_div(F.max("total_spend").cast("double"), F.max("customers_acquired")).alias("_cac")
    )
    per_key = dim_campaign.select("dim_campaign_key", "campaign_id", "channel").join(cost, "campaign_id", "left")
    per_key = per_key.select(
        "dim_campaign_key",
        F.when(F.upper("channel") == "ORGANIC", F.lit(0)).otherwise(F.col("_cac")).alias("customer_acquisition_cost"),
    )
    priced = salted_lookup(attribution, per_key, "dim_campaign_key", (UNKNOWN_KEY, ORGANIC_KEY), "left")
    return priced.select("customer_id", "customer_acquisition_cost")


def exact_quantiles(df: DataFrame, col: str, shares: Sequence[float], pieces: int = 256) -> DataFrame:
    """One row, one array: the least value whose cumulative share reaches each of ``shares``.

    Values are counted first; a sketch then deals the distinct ones into about equal pieces, in which running sums are
    formed, and the only window over everything sees one row for each piece. The sketch decides the balance alone.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    bounds = counts.agg(F.percentile_approx("_v", [i / pieces for i in range(1, pieces)])).scalar()
    counts = counts.withColumn("_bounds", bounds)
    counts = counts.withColumn("_piece", F.size(F.filter("_bounds", lambda b: b < F.col("_v")))).drop("_bounds")
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy("_piece").agg(F.sum("_n").alias("_size"))
    sizes = sizes.select("_piece", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    total = counts.agg(F.sum("_n")).scalar()
    inside = Window.partitionBy("_piece").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("_n").over(inside)).join(sizes, "_piece")
    ranked = ranked.select("_v", (F.col("_upto") + F.col("_before")).alias("_rank"), total.alias("_total"))
    need = [F.col("_total") - F.floor(F.col("_total") - F.col("_total") * F.lit(float(s))) for s in shares]
    return ranked.agg(F.array(*[F.min(F.when(F.col("_rank") >= n, F.col("_v"))) for n in need]).alias("cuts"))


def rfm(
    metrics: DataFrame, as_of: date, thresholds: Mapping[str, Sequence[float]] | None = None, scores: int = 5
) -> DataFrame:
    """Recency, frequency and monetary scores and a three-digit segment.

    ``thresholds`` holds ascending cut points per input. Without them the cut points are the exact discrete quantiles.
    """
    inputs = metrics.withColumns(
        {
            "recency_days": F.datediff(F.lit(as_of), F.col("last_order_date")),
            "frequency": F.col("total_orders"),
            "monetary": F.col("lifetime_revenue"),
        }
    )
    names = {"recency": "recency_days", "frequency": "frequency", "monetary": "monetary"}
    cuts: dict[str, list[Column]] = {}
    if thresholds is not None:
        cuts = {name: [F.lit(t) for t in thresholds[name]] for name in names}
    else:
        shares = [i / scores for i in range(1, scores)]
        found = [exact_quantiles(inputs, col, shares).scalar().alias(name) for name, col in names.items()]
        inputs = inputs.withColumn("_cuts", F.struct(*found))
        cuts = {name: [F.element_at(F.col(f"_cuts.{name}"), i) for i in range(1, scores)] for name in names}

    def passed(name: str) -> Column:
        out = F.lit(1)
        for cut in cuts[name]:
            out = out + F.when(F.col(names[name]) > cut, F.lit(1)).otherwise(F.lit(0))
        return out

    # low recency is good, so its score runs the other way
    r = F.lit(len(cuts["recency"]) + 2) - passed("recency")
    scored = inputs.withColumns({"r_score": r, "f_score": passed("frequency"), "m_score": passed("monetary")})
    return scored.withColumn("rfm_segment", F.concat("r_score", "f_score", "m_score")).drop("_cuts")


def loyalty_tier(metrics: DataFrame, tiers: Sequence[tuple[str, float]], spend: str = "lifetime_revenue") -> DataFrame:
    """Tier by cumulative spend: the highest tier whose floor is reached."""
    tier = F
    for name, floor in sorted(tiers, key=lambda t: -t[1]):
        tier = tier.when(F.col(spend) >= F.lit(floor), F.lit(name))
    return metrics.withColumn("loyalty_tier", tier)


def apply_agg_rules(df: DataFrame, rules: Sequence[Mapping]) -> dict[str, DataFrame]:
    """Configured aggregates. Rules with the same ``group_by_columns`` are computed in one grouping.

    A rule: aggregation_type, source_column, target_column, group_by_columns (comma list), filter_expression.
    CUSTOM takes a whole aggregate expression in ``source_column`` (a bare column is summed).
    """
    groups: dict[str, list[Column]] = {}
    for r in rules:
        if not r.get("is_active", True):
            continue
        kind, source = r["aggregation_type"].upper(), r.get("source_column")
        cond = r.get("filter_expression")

        def kept(value: Column) -> Column:
            return F.when(F.expr(cond), value) if cond else value

        if kind == "CUSTOM":
            expr = F.expr(source) if "(" in source else F.sum(kept(F.col(source)))
        elif kind == "COUNT":
            expr = F.count(kept(F.expr(source) if source else F.lit(1)))
        elif kind == "DISTINCT_COUNT":
            expr = F.countDistinct(kept(F.expr(source)))
        else:
            expr = {"SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max}[kind](kept(F.expr(source)))
        groups.setdefault(r.get("group_by_columns") or "", []).append(expr.alias(r["target_column"]))
    out = {}
    for keys, exprs in groups.items():
        cols = [k.strip() for k in keys.split(",") if k.strip()]
        out[keys] = df.groupBy(*cols).agg(*exprs) if cols else df.agg(*exprs)
    return out
