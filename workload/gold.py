"""Gold, semantic, governance, lineage, sink and streaming queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions.exprs import UNKNOWN_KEY, year_month
from tidemark.functions.masking import MASKED, mask_email, mask_phone, mask_string
from tidemark.operators import quality as q
from tidemark.operators.contracts import CONTRACTS, to_contract
from tidemark.operators.digests import reconcile_ranges
from tidemark.operators.governance import apply_policy, row_filter
from tidemark.operators.history import scd2, shown_versions
from tidemark.operators.joins import key_sketch, sketched_keys
from tidemark.operators.lineage import dependency_levels
from tidemark.operators.merge import merge_fact
from tidemark.operators.quality import reconcile_sum, unknown_usage
from tidemark.plans import aggregates, dims, facts, impact, views
from tidemark.plans.metrics import campaign_costs, query_metrics
from tidemark.plans.published import published
from tidemark.plans.quality_rules import GOLD_MEASURES, GOLD_UNIQUE, SILVER_DQ
from tidemark.session import durable, durable_parts, scratch_path
from tidemark.sources.calendar import calendar_for
from tidemark.sources.sinks import append_table, overwrite_partitions, write_table
from tidemark.streaming import jobs
from tidemark.streaming.state import PartitionedState
from workload.model import LINES, gold, plain, r4
from workload.silver import TS, ts
from workload.sql_entities import cents, ratio, sql

QUERIES: list[tuple] = []


def query(name: str, statement: str | None):
    def register(fn):
        QUERIES.append((name, fn, statement))
        return fn

    return register


# -- dimensions ---------------------------------------------------------------------------------------------------

_CUSTOMER_COLS = [
    "dim_customer_key", "customer_id", "email", "phone", "full_name", "gender", "customer_type", "status",
    "marketing_opt_in", "registration_date", "_valid_from", "_valid_to", "_is_current", "_version",
]
_CUSTOMER_SQL = f"""dim_customer_key, customer_id, email, phone, full_name, gender, customer_type, status,
    CAST(marketing_opt_in AS INTEGER) AS marketing_opt_in, {ts('registration_date')}, {ts('_valid_from')}"""


@query(
    "dim_customer_initial",
    sql("dim_customer_first", body=f"""SELECT {_CUSTOMER_SQL}, 1 AS _version FROM dim_customer_first
        UNION ALL SELECT -1, -1, NULL, NULL, 'UNKNOWN', NULL, NULL, 'UNKNOWN', 0, NULL, '1900-01-01 00:00:00', 1"""),
)
def dim_customer_initial(spark, sf_dir):
    d = gold(spark, sf_dir).build_dim("dim_customer_first")
    return plain(d.select(*[c for c in _CUSTOMER_COLS if c not in ("_valid_to", "_is_current")]))


@query(
    "dim_customer",
    sql("dim_customer", body=f"""SELECT {_CUSTOMER_SQL}, {ts('_valid_to')}, CAST(_is_current AS INTEGER) AS _is_current,
        _version FROM dim_customer"""),
)
def dim_customer(spark, sf_dir):
    return plain(gold(spark, sf_dir).build_dim("dim_customer").select(*_CUSTOMER_COLS))


def _dim(name: str, statement: str):
    def run(spark, sf_dir):
        d = gold(spark, sf_dir).build_dim(name)
        return plain(d.drop("_created_date", "_last_modified_date", "_pipeline_run_id"))

    query(name, statement)(run)


_dim("dim_product", sql("dim_product", body="""SELECT dim_product_key, inventory_item_id, sku, product_name, category_name,
    brand_name, CAST(unit_cost AS DOUBLE) AS unit_cost FROM dim_product"""))
_dim("dim_location", sql("dim_location", body="SELECT * FROM dim_location"))
_dim("dim_campaign", sql("dim_campaign", body="SELECT * FROM dim_campaign"))
_dim("dim_registration_source", sql("dim_registration_source", body="SELECT * FROM dim_registration_source"))


@query(
    "dim_date_orders",
    sql("dim_date", body="""SELECT d.* REPLACE (CAST(is_weekend AS INTEGER) AS is_weekend,
        CAST(is_holiday AS INTEGER) AS is_holiday), count(o_orderkey) AS orders
        FROM dim_date d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = full_date
        WHERE full_date BETWEEN (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)
                            AND (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
        GROUP BY ALL"""),
)
def dim_date_orders(spark, sf_dir):
    orders = gold(spark, sf_dir).raw.table("orders")
    days = calendar_for(orders, "o_orderdate")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count("o_orderkey").alias("orders")
    )
    return plain(days.join(per_day, "full_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0))))


# -- facts --------------------------------------------------------------------------------------------------------

@query(
    "fact_sales",
    sql("fact_sales", body="""SELECT * REPLACE (CAST(line_total AS DOUBLE) AS line_total,
        CAST(unit_price AS DOUBLE) AS unit_price) FROM fact_sales"""),
)
def fact_sales(spark, sf_dir):
    f = gold(spark, sf_dir).build_fact("fact_sales")
    return plain(f.drop("_created_date", "_last_modified_date", "_pipeline_run_id"))


@query(
    "fact_sales_any_versions",
    sql("fact_sales", body="SELECT line_id, dim_customer_key, dim_campaign_key FROM fact_sales"),
)
def fact_sales_any_versions(spark, sf_dir):
    # the lookup that holds for any number of versions per customer
    f = gold(spark, sf_dir).build_fact("fact_sales", measured=False)
    return f.select("line_id", "dim_customer_key", "dim_campaign_key")


@query("fact_interactions", sql("fact_interactions", body="SELECT * FROM fact_interactions"))
def fact_interactions(spark, sf_dir):
    f = gold(spark, sf_dir).build_fact("fact_interactions")
    return f.drop("_created_date", "_last_modified_date", "_pipeline_run_id")


@query("fact_surveys", sql("fact_surveys", body="SELECT * FROM fact_surveys"))
def fact_surveys(spark, sf_dir):
    f = gold(spark, sf_dir).build_fact("fact_surveys")
    return f.drop("_created_date", "_last_modified_date", "_pipeline_run_id", "nps_category")


def _refreshed(spark, old, new, key, partition, deleted=None):
    """A stored fact after a batch was merged into it."""
    state = PartitionedState(spark, scratch_path(spark, "fact"), partition)
    jobs.refresh_fact(state, key, old, 0)
    jobs.refresh_fact(state, key, new, 1, deleted)
    return state.read()


def _sales_after(spark, g, old, headers, orders, found, bound):
    """Stored sales facts, given as slices ``old``, after those of some orders were built anew."""
    state = PartitionedState(spark, scratch_path(spark, "fact"), "order_year_month")
    jobs.refresh_fact(state, "line_id", old, 0)
    orders, crs = durable(impact.union_keys(orders, "order_id"), "orders"), g.silver("customer_registration_source")
    slices = g.in_slices(headers, orders)
    rows = (facts.build_fact_sales(lines, some, found, crs, versions_per_key=bound) for some, lines in slices)
    rows = durable_parts(spark, rows, "fact")
    g.unstage(LINES)
    jobs.refresh_fact(state, "line_id", rows, 1, stored=True)
    state.prune(1)  # nobody else reads the facts as they were
    return state.read()


@query(
    "fact_sales_after_lookup_change",
    sql("fact_sales", body="""SELECT * REPLACE (CAST(line_total AS DOUBLE) AS line_total,
        CAST(unit_price AS DOUBLE) AS unit_price) FROM fact_sales"""),
)
def fact_sales_after_lookup_change(spark, sf_dir):
    # no order changes: channel and campaign of a third of the customers were others when the facts were stored
    g = gold(spark, sf_dir)
    s, found, bound = g.silver, g.dims(), facts.version_bound(g.dim("dim_customer"))
    crs = s("customer_registration_source")
    third = F.col("customer_id") % 3 == 0
    was = crs.withColumns(
        {"campaign_id": F.when(third, F.col("campaign_id") % 11 + 1).otherwise(F.col("campaign_id")),
         "channel": F.when(third, F.lit("ORGANIC")).otherwise(F.col("channel"))}
    )
    headers, lines = s("oe_order_headers_all"), g.stored_lines()
    old = (facts.build_fact_sales(its, some, found, was, versions_per_key=bound) for some, its in g.in_slices(headers))
    answers = (facts.campaign_attribution(x, found["dim_campaign"]) for x in (was, crs))
    attributed = impact.changed_keys(*answers, "customer_id", ["dim_campaign_key"])
    orders = impact.sales_orders(headers, lines, attributed=attributed)
    out = _sales_after(spark, g, old, headers, orders, found, bound)
    return plain(out.drop("_created_date", "_last_modified_date", "_pipeline_run_id"))


@query(
    "fact_sales_late_customer",
    sql("fact_sales", "dim_customer", body="""SELECT line_id, coalesce(customer_id, -1) AS customer_id,
        coalesce(_version, 1) AS _version FROM fact_sales LEFT JOIN dim_customer USING (dim_customer_key)"""),
)
def fact_sales_late_customer(spark, sf_dir):
    # facts stand at the unknown member until their customer arrives; surrogate keys depend on the order of arrival
    g = gold(spark, sf_dir)
    s, customers = g.silver, g.silver("customers")
    early = durable(dims.build_dim_customer(None, customers.filter("customer_id % 5 <> 0")), "dim_customer")
    found = {**g.dims(), "dim_customer": early}
    headers, lines = s("oe_order_headers_all"), g.stored_lines()
    crs = s("customer_registration_source")
    old = (facts.build_fact_sales(its, some, found, crs, versions_per_key=1) for some, its in g.in_slices(headers))
    arrived = durable(dims.build_dim_customer(early, customers), "dim_customer")
    late = durable(dims.build_dim_customer(arrived, g.customers_v2()), "dim_customer")
    members = (d.filter("dim_customer_key > 0") for d in (early, late))
    moved = impact.changed_since(*members, "customer_id", "dim_customer_key")
    orders = impact.sales_orders(headers, lines, customers=moved)
    out = _sales_after(spark, g, old, headers, orders, {**found, "dim_customer": late}, facts.version_bound(late))
    owner = late.select("dim_customer_key", "customer_id", "_version")
    return out.join(owner, "dim_customer_key").select("line_id", "customer_id", "_version")


@query(
    "fact_interactions_after_incident_delete",
    sql("fact_interactions", body="SELECT * FROM fact_interactions WHERE incident_id % 5 <> 0"),
)
def fact_interactions_after_incident_delete(spark, sf_dir):
    # no interaction changes: their incidents go
    g = gold(spark, sf_dir)
    interactions, was = g.silver("interactions"), g.silver("incidents")
    left = was.filter("incident_id % 5 <> 0")
    changed = impact.changed_keys(was, left, "incident_id", ["customer_id", "status", "priority"])
    wanted = impact.union_keys(impact.interactions_of(interactions, left, changed, None), "interaction_id")
    theirs = interactions.join(wanted, "interaction_id", "left_semi")
    rows = durable(facts.build_fact_interactions(theirs, left, g.dim("dim_customer")), "rows")
    stale = wanted.join(rows.select("interaction_id"), "interaction_id", "left_anti")
    out = _refreshed(spark, g.fact("fact_interactions"), rows, "interaction_id", "interaction_year_month", stale)
    return out.drop("_created_date", "_last_modified_date", "_pipeline_run_id")


@query(
    "surveys_on_delivered",
    sql("surveys", "headers", body="""SELECT survey_id, order_id FROM surveys
        WHERE order_id IN (SELECT order_id FROM headers WHERE order_status = 'DELIVERED')"""),
)
def surveys_on_delivered(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    return facts.surveys_on_delivered(s("surveys"), s("oe_order_headers_all")).select("survey_id", "order_id")


@query("campaign_attribution", sql("attribution", body="SELECT * FROM attribution"))
def campaign_attribution(spark, sf_dir):
    g = gold(spark, sf_dir)
    return facts.campaign_attribution(g.silver("customer_registration_source"), g.dim("dim_campaign"))


# -- aggregates ---------------------------------------------------------------------------------------------------

_ROI_SQL = f"""year_month, dim_campaign_key, campaign_name, channel, total_revenue, total_orders, total_spend,
    customers_acquired, CASE WHEN channel = 'ORGANIC' THEN 0.0 WHEN customers_acquired = 0 THEN NULL
      ELSE CAST((2 * CAST(round(total_spend * 100) AS BIGINT) + customers_acquired) // (2 * customers_acquired) AS DOUBLE)
      / 100 END AS customer_acquisition_cost,
    {ratio(cents('total_revenue'), cents('total_spend'))} AS return_on_ad_spend"""


def _ratios(df, *names):
    return plain(df.withColumns({n: r4(n) for n in names}))


@query("agg_monthly_campaign_roi", sql("roi", body=f"SELECT {_ROI_SQL} FROM roi"))
def agg_monthly_campaign_roi(spark, sf_dir):
    return _ratios(gold(spark, sf_dir).roi(), "return_on_ad_spend")


_AOV = ratio(cents("lifetime_revenue"), "total_orders * 100")
_SPAN = "date_diff('day', first_order_date, last_order_date)"
_CLV_SQL = f"""{_AOV} AS average_order_value, {ratio('total_orders * 30', _SPAN)} AS purchase_frequency"""


@query("agg_customer_clv", sql("clv", body=f"SELECT *, {_CLV_SQL} FROM clv"))
def agg_customer_clv(spark, sf_dir):
    return _ratios(gold(spark, sf_dir).clv(), "average_order_value", "purchase_frequency")


@query(
    "agg_clv_by_customer",
    sql("clv_by_customer", body=f"""SELECT customer_id, status, lifetime_revenue, total_orders, total_items_purchased,
        first_order_date, last_order_date, churn_date, customer_lifespan_days, lifespan_months, {_CLV_SQL}
        FROM clv_by_customer"""),
)
def agg_clv_by_customer(spark, sf_dir):
    m = gold(spark, sf_dir).clv_by_customer().drop("registration_date")
    return _ratios(m, "average_order_value", "purchase_frequency")


def _sales_before(fact):
    """An earlier state of the sales facts, and the order numbers that differ: some orders are missing, some stand at
    another customer, day or amount, some have since been deleted."""
    digit = F.col("order_id") % 10
    rest = fact.filter(digit > 2)
    moved = fact.filter(digit == 2).withColumns(
        {"dim_customer_key": F.lit(-1).cast("long"), "dim_date_key": F.lit(19940102), "line_total": F.col("line_total") * 3}
    )
    dropped = fact.filter(digit == 3).withColumns(
        {"order_number": F.concat(F.lit("X"), "order_number"), "line_id": -F.col("line_id"), "dim_date_key": F.lit(20011231)}
    )
    moved = moved.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fact.schema.fields])
    dropped = dropped.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fact.schema.fields])
    numbers = fact.filter(digit <= 2).select("order_number").unionByName(dropped.select("order_number"))
    return durable(rest.unionByName(moved).unionByName(dropped), "sales-before"), durable(numbers.distinct(), "numbers")


@query("agg_customer_clv_incremental", sql("clv", body=f"SELECT *, {_CLV_SQL} FROM clv"))
def agg_customer_clv_incremental(spark, sf_dir):
    g = gold(spark, sf_dir)
    fact, days = g.fact("fact_sales"), g.dim("dim_date")
    was, numbers = _sales_before(fact)
    stored = durable(aggregates.customer_measures(was, days), "measures")
    before, after = (durable(aggregates.touched_facts(f, numbers), "touched") for f in (was, fact))
    measures = aggregates.follow_customers(stored, before, after, fact, days)
    out = aggregates.finish_customer_clv(measures, g.dim("dim_customer"))
    return _ratios(out, "average_order_value", "purchase_frequency")


@query("agg_campaign_roi_incremental", sql("roi", body=f"SELECT {_ROI_SQL} FROM roi"))
def agg_campaign_roi_incremental(spark, sf_dir):
    g = gold(spark, sf_dir)
    fact, days = g.fact("fact_sales"), g.dim("dim_date")
    was, numbers = _sales_before(fact)
    stored = durable(aggregates.campaign_measures(was, days), "measures")
    measures = aggregates.follow_campaigns(stored, *(aggregates.touched_facts(f, numbers) for f in (was, fact)), days)
    out = aggregates.finish_campaign_roi(measures, g.dim("dim_campaign"), g.silver("marketing_campaigns"))
    return _ratios(out, "return_on_ad_spend")


_CLV_VALUE = """
    SELECT c.customer_id, CASE WHEN m.total_orders >= 1 THEN 'Existing' ELSE 'New' END AS segment,
           coalesce(m.total_orders, 0) AS total_orders,
           round(CASE WHEN m.total_orders >= 1 THEN m.lifetime_revenue / m.total_orders
             * coalesce(CAST(m.total_orders * 30 AS DOUBLE)
                        / nullif(date_diff('day', m.first_order_date, m.last_order_date), 0), 0)
             * (CAST(m.customer_lifespan_days AS DOUBLE) / 30) - coalesce(x.cac, 0) END, 2) AS customer_lifetime_value,
           round(CASE WHEN m.total_orders >= 1 THEN m.lifetime_revenue - coalesce(x.cac, 0) END, 2) AS net_lifetime_value
    FROM customers c LEFT JOIN clv_by_customer m USING (customer_id)
    LEFT JOIN (SELECT a.customer_id, CASE WHEN k.channel = 'ORGANIC' THEN 0
                 ELSE CAST(g.total_spend AS DOUBLE) / nullif(g.customers_acquired, 0) END AS cac
               FROM attribution a JOIN dim_campaign k USING (dim_campaign_key)
               LEFT JOIN campaigns g ON g.campaign_id = k.campaign_id) x ON x.customer_id = c.customer_id"""


@query(
    "customer_lifetime_value",
    sql("customers", "clv_by_customer", "attribution", "dim_campaign", "campaigns", body=_CLV_VALUE),
)
def customer_lifetime_value(spark, sf_dir):
    g = gold(spark, sf_dir)
    attribution = facts.campaign_attribution(g.silver("customer_registration_source"), g.dim("dim_campaign"))
    cac = aggregates.customer_cac(attribution, g.dim("dim_campaign"), g.silver("marketing_campaigns"))
    out = aggregates.clv(g.clv_by_customer(), cac, g.silver("customers"))
    return out.withColumns(
        {c: F.round(c, 2) for c in ("customer_lifetime_value", "net_lifetime_value")}
    )


@query(
    "cac_by_channel",
    sql("campaigns", body="""SELECT channel, CAST(sum(total_spend) AS DOUBLE) AS total_spend,
        CAST(sum(customers_acquired) AS BIGINT) AS customers_acquired,
        CASE WHEN channel = 'ORGANIC' THEN 0.0 ELSE """ + ratio("sum(total_spend) * 100", "sum(customers_acquired) * 100") + """
        END AS customer_acquisition_cost FROM campaigns GROUP BY 1"""),
)
def cac_by_channel(spark, sf_dir):
    return _ratios(
        aggregates.campaign_cac(gold(spark, sf_dir).silver("marketing_campaigns")), "customer_acquisition_cost"
    )


@query(
    "aov_revenue_orders",
    sql("headers", body="""SELECT _order_year_month, count(DISTINCT order_id) AS orders,
        """ + ratio("sum(total_amount) * 100", "count(DISTINCT order_id) * 100") + """ AS average_order_value FROM headers
        WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY 1"""),
)
def aov_revenue_orders(spark, sf_dir):
    h = facts.revenue_orders(gold(spark, sf_dir).silver("oe_order_headers_all"))
    m = h.groupBy("_order_year_month").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("total_amount").alias("_total")
    )
    return m.select("_order_year_month", "orders", r4(F.try_divide("_total", "orders")).alias("average_order_value"))


_RULES = [
    {"aggregation_type": "SUM", "source_column": "line_total", "target_column": "total_revenue",
     "group_by_columns": "order_year_month,dim_campaign_key"},
    {"aggregation_type": "DISTINCT_COUNT", "source_column": "order_number", "target_column": "orders",
     "group_by_columns": "order_year_month,dim_campaign_key"},
    {"aggregation_type": "COUNT", "source_column": None, "target_column": "delivered_lines",
     "group_by_columns": "order_year_month,dim_campaign_key", "filter_expression": "order_status = 'DELIVERED'"},
    {"aggregation_type": "AVG", "source_column": "quantity", "target_column": "avg_quantity",
     "group_by_columns": "order_year_month,dim_campaign_key"},
    {"aggregation_type": "MIN", "source_column": "unit_price", "target_column": "min_price",
     "group_by_columns": "order_year_month,dim_campaign_key"},
    {"aggregation_type": "MAX", "source_column": "unit_price", "target_column": "max_price",
     "group_by_columns": "order_year_month,dim_campaign_key"},
    {"aggregation_type": "CUSTOM", "source_column": "allocated_tax_amount", "target_column": "tax",
     "group_by_columns": "order_year_month,dim_campaign_key"},
    {"aggregation_type": "CUSTOM", "source_column": "line_total", "target_column": "lifetime_revenue",
     "group_by_columns": "dim_customer_key"},
]


@query(
    "agg_rules_campaign_month",
    sql("fact_sales", body="""SELECT order_year_month, dim_campaign_key, CAST(sum(line_total) AS DOUBLE) AS total_revenue,
        count(DISTINCT order_number) AS orders, count(*) FILTER (WHERE order_status = 'DELIVERED') AS delivered_lines,
        """ + ratio("sum(quantity)", "count(*)") + """ AS avg_quantity, CAST(min(unit_price) AS DOUBLE) AS min_price,
        CAST(max(unit_price) AS DOUBLE) AS max_price, round(sum(allocated_tax_amount), 2) AS tax
        FROM fact_sales GROUP BY 1, 2"""),
)
def agg_rules_campaign_month(spark, sf_dir):
    out = aggregates.apply_agg_rules(gold(spark, sf_dir).fact("fact_sales"), _RULES)
    return _ratios(out["order_year_month,dim_campaign_key"], "avg_quantity")


@query(
    "agg_rules_customer",
    sql("fact_sales", body="""SELECT dim_customer_key, CAST(sum(line_total) AS DOUBLE) AS lifetime_revenue FROM fact_sales
        GROUP BY 1"""),
)
def agg_rules_customer(spark, sf_dir):
    return plain(aggregates.apply_agg_rules(gold(spark, sf_dir).fact("fact_sales"), _RULES)["dim_customer_key"])


_CUTS = {"recency": [60, 150, 300, 600], "frequency": [3, 6, 9, 12],
         "monetary": [100_000, 300_000, 600_000, 1_000_000]}
_TIERS = [("Bronze", 0), ("Silver", 250_000), ("Gold", 750_000), ("Platinum", 1_500_000)]


def _score(col: str, cuts: list[int]) -> str:
    return "1 + " + " + ".join(f"CAST({col} > {c} AS INTEGER)" for c in cuts)


@query(
    "tier_history",
    sql("fact_sales", "dim_customer", body="""FROM (WITH spent AS (
          SELECT c.customer_id, CAST(sum(line_total) FILTER (dim_date_key < 19980101) AS DOUBLE) AS early,
                 CAST(sum(line_total) AS DOUBLE) AS late
          FROM fact_sales f JOIN dim_customer c USING (dim_customer_key) WHERE c.customer_id > 0 GROUP BY 1),
        tiers AS (SELECT customer_id, CASE WHEN early >= 1500000 THEN 'Platinum' WHEN early >= 750000 THEN 'Gold'
                    WHEN early >= 250000 THEN 'Silver' WHEN early IS NOT NULL THEN 'Bronze' END AS a,
                    CASE WHEN late >= 1500000 THEN 'Platinum' WHEN late >= 750000 THEN 'Gold'
                    WHEN late >= 250000 THEN 'Silver' ELSE 'Bronze' END AS b FROM spent)
        SELECT customer_id, a AS loyalty_tier, '1998-01-01 00:00:00' AS _valid_from,
               CASE WHEN a <> b THEN '2002-01-01 00:00:00' END AS _valid_to, 1 AS _version FROM tiers WHERE a IS NOT NULL
        UNION ALL
        SELECT customer_id, b, '2002-01-01 00:00:00', NULL, CASE WHEN a IS NULL THEN 1 ELSE 2 END FROM tiers
        WHERE a IS DISTINCT FROM b)"""),
)
def tier_history(spark, sf_dir):
    # the tier of each customer as it stood on two days, as type 2 history
    g = gold(spark, sf_dir)
    spent = g.fact("fact_sales").join(g.dim("dim_customer").select("dim_customer_key", "customer_id"), "dim_customer_key")

    def tiers(rows, day: str):
        total = rows.filter("customer_id > 0").groupBy("customer_id").agg(F.sum("line_total").alias("lifetime_revenue"))
        return aggregates.loyalty_tier(total, _TIERS).withColumn("as_of", F.lit(day).cast("timestamp"))

    args = (["customer_id"], ["loyalty_tier"], "as_of")
    first = scd2(None, tiers(spent.filter("dim_date_key < 19980101"), "1998-01-01"), *args)
    out = scd2(first, tiers(spent, "2002-01-01"), *args)
    return plain(out.select("customer_id", "loyalty_tier", "_valid_from", "_valid_to", "_version"))


def _quantile_score(col: str) -> str:
    return "1 + " + " + ".join(f"CAST({col} > quantile_disc({col}, {i / 5}) OVER () AS INTEGER)" for i in range(1, 5))


@query(
    "rfm_segments",
    sql("clv_by_customer", body=f"""SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_segment FROM (
        SELECT customer_id, recency_days, 6 - ({_score('recency_days', _CUTS['recency'])}) AS r_score,
               {_score('total_orders', _CUTS['frequency'])} AS f_score,
               {_score('lifetime_revenue', _CUTS['monetary'])} AS m_score
        FROM (SELECT *, CAST(date_diff('day', last_order_date, DATE '2001-09-01') AS INTEGER) AS recency_days
              FROM clv_by_customer))"""),
)
def rfm_segments(spark, sf_dir):
    out = aggregates.rfm(gold(spark, sf_dir).clv_by_customer(), date(2001, 9, 1), _CUTS)
    return out.select("customer_id", "recency_days", "r_score", "f_score", "m_score", "rfm_segment")


@query(
    "rfm_quantile_segments",
    sql("clv_by_customer", body=f"""SELECT rfm_segment, count(*) AS customers FROM (
        SELECT CAST(r AS VARCHAR) || f || m AS rfm_segment FROM (SELECT
            6 - ({_quantile_score('recency_days')}) AS r, {_quantile_score('total_orders')} AS f,
            {_quantile_score('lifetime_revenue')} AS m
        FROM (SELECT *, date_diff('day', last_order_date, DATE '2001-09-01') AS recency_days FROM clv_by_customer) AS c)) GROUP BY 1"""),
)
def rfm_quantile_segments(spark, sf_dir):
    out = aggregates.rfm(gold(spark, sf_dir).clv_by_customer(), date(2001, 9, 1))
    return out.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "loyalty_tiers",
    sql("clv_by_customer", body="""SELECT customer_id, CASE WHEN lifetime_revenue >= 1500000 THEN 'Platinum'
        WHEN lifetime_revenue >= 750000 THEN 'Gold' WHEN lifetime_revenue >= 250000 THEN 'Silver' ELSE 'Bronze' END
        AS loyalty_tier FROM clv_by_customer"""),
)
def loyalty_tiers(spark, sf_dir):
    return aggregates.loyalty_tier(gold(spark, sf_dir).clv_by_customer(), _TIERS).select("customer_id", "loyalty_tier")


# -- gold quality -------------------------------------------------------------------------------------------------

@query(
    "gold_unknown_usage",
    sql("fact_sales", body="\nUNION ALL\n".join(
        f"""SELECT '{k}' AS key_column, {ratio(f"100 * count(*) FILTER (WHERE {k} = -1)", "count(*)")} AS unknown_pct,
            CAST(100.0 * count(*) FILTER (WHERE {k} = -1) / count(*) > 5 AS INTEGER) AS over_threshold FROM fact_sales"""
        for k in ("dim_customer_key", "dim_product_key", "dim_location_key", "dim_campaign_key"))),
)
def gold_unknown_usage(spark, sf_dir):
    f = gold(spark, sf_dir).fact("fact_sales")
    out = unknown_usage(f, ["dim_customer_key", "dim_product_key", "dim_location_key", "dim_campaign_key"])
    return _ratios(out, "unknown_pct")


@query(
    "gold_reconcile_roi",
    sql("roi", "fact_sales", body="""SELECT 'DQ-G-A-001' AS rule_id, total_a, total_b,
        round(abs(total_a - total_b), 2) AS variance, CAST(abs(total_a - total_b) < 1 AS INTEGER) AS matched
        FROM (SELECT (SELECT round(sum(total_revenue), 2) FROM roi) AS total_a,
                     (SELECT CAST(sum(line_total) AS DOUBLE) FROM fact_sales) AS total_b)"""),
)
def gold_reconcile_roi(spark, sf_dir):
    g = gold(spark, sf_dir)
    return plain(reconcile_sum(g.roi(), "total_revenue", g.fact("fact_sales"), "line_total"))


@query(
    "gold_uniqueness",
    sql("dim_customer", "dim_product", "dim_location", "dim_campaign", "dim_registration_source", body="""
        SELECT 'DQ-G-D-001' AS rule_id, count(*) AS violations FROM (SELECT customer_id FROM dim_customer WHERE _is_current
          GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'DQ-G-D-003', count(*) FROM (SELECT 1 FROM dim_product GROUP BY inventory_item_id HAVING count(*) > 1)
        UNION ALL SELECT 'DQ-G-D-004', count(*) FROM (SELECT 1 FROM dim_location GROUP BY address_id HAVING count(*) > 1)
        UNION ALL SELECT 'DQ-G-D-005', count(*) FROM (SELECT 1 FROM dim_campaign GROUP BY campaign_id HAVING count(*) > 1)
        UNION ALL SELECT 'DQ-G-D-006', count(*) FROM (SELECT 1 FROM dim_registration_source GROUP BY registration_source_id
          HAVING count(*) > 1)"""),
)
def gold_uniqueness(spark, sf_dir):
    g = gold(spark, sf_dir)
    out = None
    for rule_id, name, keys, where in GOLD_UNIQUE:
        bad = q.uniqueness_violations(g.dim(name), keys, where)
        part = bad.agg(F.lit(rule_id).alias("rule_id"), F.count(F.lit(1)).alias("violations"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "gold_measure_rules",
    sql("fact_sales", "fact_surveys", body="""
        SELECT 'fact_sales' AS table_name, count(*) AS total_records_checked, 'DQ-G-M-001' AS rule_id,
               'SKIP_ROW' AS severity, count(*) FILTER (WHERE line_total < 0) AS failed_count FROM fact_sales
        UNION ALL SELECT 'fact_surveys', count(*), 'DQ-G-M-002', 'SKIP_ROW', count(*) FILTER (WHERE nps_score > 10)
        FROM fact_surveys"""),
)
def gold_measure_rules(spark, sf_dir):
    g = gold(spark, sf_dir)
    sales = q.dq_summary(g.fact("fact_sales"), GOLD_MEASURES["fact_sales"], "fact_sales")
    surveys = q.dq_summary(g.fact("fact_surveys"), GOLD_MEASURES["fact_surveys"], "fact_surveys")
    return sales.unionByName(surveys)


@query("gold_scd_validity", sql("dim_customer", body="""SELECT customer_id, _version FROM dim_customer
    WHERE _valid_from >= coalesce(_valid_to, TIMESTAMP '2099-12-31')"""))
def gold_scd_validity(spark, sf_dir):
    return q.scd_violations(gold(spark, sf_dir).dim("dim_customer"), ["customer_id"]).select("customer_id", "_version")


@query(
    "contract_customer_metrics",
    sql("clv_by_customer", body="""SELECT CAST(customer_id AS VARCHAR) AS customer_id,
        CAST((2 * CAST(round(lifetime_revenue * 100) AS BIGINT) + total_orders) // (2 * total_orders) AS DOUBLE) / 100
          AS average_order_value,
        CAST((2 * total_orders * 300000 + days) // (2 * days) AS DOUBLE) / 10000 AS purchase_frequency,
        lifetime_revenue AS total_lifetime_revenue
        FROM (SELECT *, nullif(date_diff('day', first_order_date, last_order_date), 0) AS days FROM clv_by_customer)"""),
)
def contract_customer_metrics(spark, sf_dir):
    out = to_contract(
        gold(spark, sf_dir).clv_by_customer(), CONTRACTS["agg_customer_clv_metrics"],
        {"total_lifetime_revenue": "lifetime_revenue"},
    )
    return plain(out)


@query(
    "contract_dim_customer",
    sql("dim_customer", body="""SELECT md5(customer_id || '||' || strftime(_valid_from, '%Y-%m-%d %H:%M:%S')) AS customer_sk,
        CAST(customer_id AS VARCHAR) AS customer_id, split_part(full_name, ' ', 1) AS first_name,
        CASE WHEN contains(full_name, ' ') THEN substring(full_name, instr(full_name, ' ') + 1) END AS last_name,
        email, status, strftime(_valid_from, '%Y-%m-%d %H:%M:%S') AS _valid_from,
        strftime(_valid_to, '%Y-%m-%d %H:%M:%S') AS _valid_to, CAST(_is_current AS INTEGER) AS _is_current, 0 AS _is_deleted
        FROM dim_customer"""),
)
def contract_dim_customer(spark, sf_dir):
    return plain(published("dim_customer", gold(spark, sf_dir).dim("dim_customer")))


@query(
    "contract_fact_sales",
    sql("fact_sales", body="""SELECT CAST(line_id AS VARCHAR) AS order_line_id, CAST(order_id AS VARCHAR) AS order_id,
        CAST(dim_customer_key AS VARCHAR) AS customer_sk, CAST(dim_product_key AS VARCHAR) AS product_sk,
        CAST(dim_campaign_key AS VARCHAR) AS campaign_sk, order_status, CAST(line_total AS DOUBLE) AS total_amount,
        CAST(strptime(CAST(dim_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS order_date FROM fact_sales"""),
)
def contract_fact_sales(spark, sf_dir):
    return plain(published("fact_sales", gold(spark, sf_dir).fact("fact_sales")))


@query(
    "contract_campaign_roi",
    sql("roi", "dim_campaign", body=f"""SELECT CAST(k.campaign_id AS VARCHAR) AS campaign_id,
        make_date(r.year_month // 100, r.year_month % 100, 1) AS reporting_month, r.total_spend,
        CAST(r.customers_acquired AS INTEGER) AS customers_acquired, r.customer_acquisition_cost
        FROM (SELECT {_ROI_SQL} FROM roi) r JOIN dim_campaign k USING (dim_campaign_key)"""),
)
def contract_campaign_roi(spark, sf_dir):
    g = gold(spark, sf_dir)
    named = g.roi().join(g.dim("dim_campaign").select("dim_campaign_key", "campaign_id"), "dim_campaign_key")
    return plain(published("agg_monthly_campaign_roi", named))


@query(
    "fact_sales_after_deletes",
    sql("fact_sales", body="""SELECT line_id, order_year_month, CAST(line_total AS DOUBLE) AS line_total FROM fact_sales
        WHERE order_status <> 'CANCELLED'"""),
)
def fact_sales_after_deletes(spark, sf_dir):
    # cancelled orders are deleted: the partitions they stood in are rewritten, the others stay
    fact = gold(spark, sf_dir).fact("fact_sales")
    gone = fact.filter("order_status = 'CANCELLED'").select("line_id", "order_year_month")
    touched = [r[0] for r in gone.select("order_year_month").distinct().collect()]
    merged = merge_fact(fact, fact.limit(0), "line_id", "order_year_month", deleted=gone, touched=touched)
    stays = fact.filter(~F.coalesce(F.col("order_year_month").isin(touched), F.lit(False)))
    return plain(merged.unionByName(stays).select("line_id", "order_year_month", "line_total"))


# -- marts --------------------------------------------------------------------------------------------------------

_DASHBOARD_SQL = """WITH who AS (SELECT dim_customer_key, customer_type, full_name AS customer_name FROM dim_customer),
             place AS (SELECT dim_location_key, state, city FROM dim_location),
             item AS (SELECT dim_product_key, brand_name, category_name, product_name FROM dim_product),
             source AS (SELECT dim_campaign_key, channel AS acquisition_channel, campaign_name FROM dim_campaign),
             line AS (SELECT dim_campaign_key, dim_location_key, dim_product_key, dim_customer_key, order_number, quantity,
                        allocated_discount_amount, CAST(line_total AS DOUBLE) AS line_total,
                        CAST(strptime(CAST(dim_date_key AS VARCHAR), '%Y%m%d') AS DATE) AS order_date FROM fact_sales)
        SELECT * EXCLUDE (dim_campaign_key, dim_location_key, dim_product_key, dim_customer_key)
        FROM line JOIN source USING (dim_campaign_key) JOIN place USING (dim_location_key) JOIN item USING (dim_product_key)
             JOIN who USING (dim_customer_key)"""
_DASHBOARD_TABLES = ("fact_sales", "dim_date", "dim_customer", "dim_product", "dim_location", "dim_campaign")


@query("mart_sales_dashboard", sql(*_DASHBOARD_TABLES, body=f"FROM ({_DASHBOARD_SQL})"))
def mart_sales_dashboard(spark, sf_dir):
    g = gold(spark, sf_dir)
    return plain(views.vw_sales_dashboard(g.fact("fact_sales"), g.dims()))


@query(
    "mart_churn_features",
    sql("clv", "dim_customer", body=f"""SELECT c.customer_id, c.status, c.customer_type, a.lifetime_revenue,
        {_AOV} AS average_order_value, a.customer_lifespan_days,
        a.total_orders, {ratio('total_orders * 30', 'customer_lifespan_days')} AS purchase_frequency_monthly
        FROM clv a JOIN dim_customer c USING (dim_customer_key) WHERE c._is_current"""),
)
def mart_churn_features(spark, sf_dir):
    g = gold(spark, sf_dir)
    out = views.vw_churn_features(g.clv(), g.dim("dim_customer"))
    return _ratios(out, "average_order_value", "purchase_frequency_monthly")


@query(
    "mart_marketing_performance",
    sql("roi", body=f"SELECT * EXCLUDE (dim_campaign_key, total_orders) FROM (SELECT {_ROI_SQL} FROM roi)"),
)
def mart_marketing_performance(spark, sf_dir):
    return _ratios(views.vw_marketing_performance(gold(spark, sf_dir).roi()), "return_on_ad_spend")


@query(
    "bi_churn_features",
    sql("clv", "dim_customer", body=f"""SELECT c.customer_id, c.status, a.lifetime_revenue,
        {_AOV} AS average_order_value, a.customer_lifespan_days
        FROM clv a JOIN dim_customer c USING (dim_customer_key) WHERE c._is_current"""),
)
def bi_churn_features(spark, sf_dir):
    g = gold(spark, sf_dir)
    return _ratios(views.churn_feature_query(g.clv(), g.dim("dim_customer")), "average_order_value")


@query(
    "bi_cac_vs_roas",
    sql("roi", body=f"""SELECT year_month, campaign_name, customer_acquisition_cost, return_on_ad_spend
        FROM (SELECT {_ROI_SQL} FROM roi)"""),
)
def bi_cac_vs_roas(spark, sf_dir):
    return _ratios(views.cac_vs_roas_query(gold(spark, sf_dir).roi()), "return_on_ad_spend")


# -- metric layer -------------------------------------------------------------------------------------------------

def _metric_tables(g):
    return {
        "fact_sales": g.fact("fact_sales"),
        "campaign_costs": campaign_costs(g.dim("dim_campaign"), g.silver("marketing_campaigns")),
    }


def _located_tables(g):
    return {**_metric_tables(g), "dim_location": g.dim("dim_location")}


_COSTS = """SELECT dim_campaign_key, k.channel, k.campaign_name, m.total_spend, m.customers_acquired,
    CASE WHEN k.channel = 'ORGANIC' THEN 0.0 WHEN m.customers_acquired = 0 THEN NULL
    ELSE CAST((2 * CAST(m.total_spend * 100 AS BIGINT) + m.customers_acquired) // (2 * m.customers_acquired) AS DOUBLE) / 100
    END AS acquisition_cost FROM dim_campaign k LEFT JOIN campaigns m ON m.campaign_id = k.campaign_id"""


@query(
    "metric_aov_by_month_status",
    sql("fact_sales", body="""SELECT order_year_month AS year_month, order_status,
        """ + ratio("sum(line_total) * 100", "count(DISTINCT order_id) * 100") + """ AS average_order_value
        FROM fact_sales WHERE order_status NOT IN ('CANCELLED', 'RETURNED') GROUP BY 1, 2"""),
)
def metric_aov(spark, sf_dir):
    out = query_metrics(
        _metric_tables(gold(spark, sf_dir)), ["average_order_value"], ["year_month", "order_status"],
        {"sales": "order_status not in ('CANCELLED', 'RETURNED')"},
    )
    return _ratios(out, "average_order_value")


@query(
    "metric_clv_by_campaign",
    sql("fact_sales", "dim_campaign", "campaigns", body=f"""SELECT dim_campaign_key AS campaign,
        round(CAST(sum(line_total) AS DOUBLE) - coalesce(max(c.acquisition_cost), 0), 2) AS customer_lifetime_value
        FROM fact_sales LEFT JOIN ({_COSTS}) c USING (dim_campaign_key) GROUP BY 1"""),
)
def metric_clv_by_campaign(spark, sf_dir):
    out = query_metrics(_metric_tables(gold(spark, sf_dir)), ["customer_lifetime_value"], ["campaign"])
    return out.select("campaign", F.round(F.col("customer_lifetime_value").cast("double"), 2).alias("customer_lifetime_value"))


@query(
    "metric_null_campaign",
    sql("fact_sales", "dim_campaign", "campaigns", body=f"""SELECT campaign,
        round(CAST(sum(line_total) AS DOUBLE) - coalesce(max(cost), 0), 2) AS customer_lifetime_value
        FROM (SELECT nullif(dim_campaign_key, 5) AS campaign, sum(line_total) AS line_total FROM fact_sales GROUP BY 1) f
        LEFT JOIN (SELECT nullif(dim_campaign_key, 5) AS c, max(acquisition_cost) AS cost FROM ({_COSTS}) GROUP BY 1) k
        ON f.campaign IS NOT DISTINCT FROM k.c GROUP BY 1"""),
)
def metric_null_campaign(spark, sf_dir):
    # the group without a campaign has revenue and cost like any other
    tables = {n: t.withColumn("dim_campaign_key", F.expr("nullif(dim_campaign_key, 5)")) for n, t in _metric_tables(gold(spark, sf_dir)).items()}
    out = query_metrics(tables, ["customer_lifetime_value"], ["campaign"]).filter("customer_lifetime_value is not null")
    return out.select("campaign", F.round(F.col("customer_lifetime_value").cast("double"), 2).alias("customer_lifetime_value"))


@query(
    "metric_campaign_without_sales",
    sql("fact_sales", "dim_campaign", "campaigns", body=f"""SELECT coalesce(f.k, c.k) AS campaign, average_order_value, customer_acquisition_cost
        FROM (SELECT dim_campaign_key AS k, {ratio("sum(line_total) * 100", "count(DISTINCT order_id) * 100")} AS average_order_value
              FROM fact_sales WHERE dim_campaign_key % 3 <> 0 GROUP BY 1) f
        FULL JOIN (SELECT dim_campaign_key AS k, {ratio("sum(total_spend) * 100", "sum(customers_acquired) * 100")}
              AS customer_acquisition_cost FROM ({_COSTS}) GROUP BY 1) c ON f.k = c.k"""),
)
def metric_campaign_without_sales(spark, sf_dir):
    tables = _metric_tables(gold(spark, sf_dir))
    out = query_metrics(
        tables, ["average_order_value", "customer_acquisition_cost"], ["campaign"], {"sales": "dim_campaign_key % 3 <> 0"}
    )
    return _ratios(out, "average_order_value", "customer_acquisition_cost")


@query(
    "metric_clv_by_customer",
    sql("fact_sales", "dim_campaign", "campaigns", body=f"""SELECT dim_customer_key AS customer,
        round(CAST(sum(line_total) AS DOUBLE) - coalesce(max(c.acquisition_cost), 0), 2) AS customer_lifetime_value
        FROM fact_sales LEFT JOIN ({_COSTS}) c USING (dim_campaign_key) GROUP BY 1"""),
)
def metric_clv_by_customer(spark, sf_dir):
    out = query_metrics(_metric_tables(gold(spark, sf_dir)), ["customer_lifetime_value"], ["customer"])
    return out.select("customer", F.round(F.col("customer_lifetime_value").cast("double"), 2).alias("customer_lifetime_value"))


@query(
    "metric_cac_by_channel",
    sql("dim_campaign", "campaigns", body=f"""SELECT channel,
        {ratio("sum(total_spend) * 100", "sum(customers_acquired) * 100")} AS customer_acquisition_cost
        FROM ({_COSTS}) GROUP BY 1"""),
)
def metric_cac(spark, sf_dir):
    out = query_metrics(_metric_tables(gold(spark, sf_dir)), ["customer_acquisition_cost"], ["channel"])
    return _ratios(out, "customer_acquisition_cost")


@query(
    "metric_frequency_by_customer",
    sql("fact_sales", body="""
        SELECT dim_customer_key AS customer,
          """ + ratio("count(DISTINCT order_id) * 30", "date_diff('day', min(d), max(d))") + """ AS purchase_frequency,
          """ + ratio("count(DISTINCT order_id)", "(2002 * 12 + 1) - (year(min(d)) * 12 + month(min(d))) "
                      "- CAST(1 < day(min(d)) AS INTEGER)") + """ AS tenure_frequency
        FROM (SELECT *, strptime(CAST(dim_date_key AS VARCHAR), '%Y%m%d')::DATE AS d FROM fact_sales) GROUP BY 1"""),
)
def metric_frequency(spark, sf_dir):
    out = query_metrics(
        _metric_tables(gold(spark, sf_dir)), ["purchase_frequency", "tenure_frequency"], ["customer"],
        params={"as_of": F.lit(date(2002, 1, 1))},
    )
    return _ratios(out, "purchase_frequency", "tenure_frequency")


@query(
    "metric_orders_by_tier",
    sql("fact_sales", "dim_location", body="""SELECT city_tier, count(DISTINCT order_id) AS orders
        FROM fact_sales JOIN dim_location USING (dim_location_key) GROUP BY 1"""),
)
def metric_orders_by_tier(spark, sf_dir):
    # the fact has no tier: distinct orders are counted again over the locations of a tier
    return query_metrics(_located_tables(gold(spark, sf_dir)), ["orders"], ["city_tier"])


@query(
    "metric_orders_by_channel",
    sql("fact_sales", "dim_campaign", body="""SELECT channel, count(DISTINCT order_id) AS orders
        FROM fact_sales JOIN dim_campaign USING (dim_campaign_key) GROUP BY 1"""),
)
def metric_orders_by_channel(spark, sf_dir):
    return query_metrics(_metric_tables(gold(spark, sf_dir)), ["orders"], ["channel"])


@query(
    "metric_cac_by_tier",
    sql("fact_sales", "dim_location", "dim_campaign", "campaigns", body=f"""
        SELECT city_tier, {ratio("sum(total_spend) * 100", "sum(customers_acquired) * 100")} AS customer_acquisition_cost
        FROM (SELECT DISTINCT city_tier, dim_campaign_key FROM fact_sales JOIN dim_location USING (dim_location_key))
        JOIN ({_COSTS}) USING (dim_campaign_key) GROUP BY 1"""),
)
def metric_cac_by_tier(spark, sf_dir):
    # two steps: locations to sales, sales to campaigns; a campaign counts once for each tier it reached
    out = query_metrics(_located_tables(gold(spark, sf_dir)), ["customer_acquisition_cost"], ["city_tier"])
    return _ratios(out, "customer_acquisition_cost")


@query(
    "metric_total_aov_cac",
    sql("fact_sales", "campaigns", body="""SELECT
        (SELECT """ + ratio("sum(line_total) * 100", "count(DISTINCT order_id) * 100") + """ FROM fact_sales)
          AS average_order_value,
        (SELECT """ + ratio("sum(total_spend) * 100", "sum(customers_acquired) * 100") + """ FROM campaigns)
          AS customer_acquisition_cost"""),
)
def metric_total(spark, sf_dir):
    out = query_metrics(_metric_tables(gold(spark, sf_dir)), ["average_order_value", "customer_acquisition_cost"], [])
    return _ratios(out, "average_order_value", "customer_acquisition_cost")


# -- hot keys -----------------------------------------------------------------------------------------------------

@query(
    "hot_suppliers",
    """SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey
       HAVING count(*) > 0.01 * (SELECT count(l_suppkey) FROM lineitem)""",
)
def hot_suppliers(spark, sf_dir):
    # a sketch for each batch, as a table would keep them; the proposed keys are counted
    lines = gold(spark, sf_dir).raw.table("lineitem")
    sketches = durable(key_sketch(lines, "l_suppkey", 0.01, ["l_returnflag"]), "sketches")
    counted = lines.filter(F.col("l_suppkey").isin(sketched_keys(sketches, 0.01))).groupBy("l_suppkey")
    total = F.lit(sketches.agg(F.sum("n")).first()[0]).cast("long")
    return counted.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 0.01 * total)


# -- governance ---------------------------------------------------------------------------------------------------

_MASK_EMAIL = """CASE WHEN {0} IS NULL THEN NULL WHEN instr({0}, '@') = 0 THEN '[REDACTED]'
    ELSE left({0}, 1) || '***@' || substring({0}, instr({0}, '@') + 1) END"""


@query(
    "mask_customers",
    sql("customers", body=f"""SELECT customer_id, {_MASK_EMAIL.format('email')} AS email,
        '***-***-' || right(phone, 4) AS phone, '[REDACTED]' AS first_name, '***MASKED***' AS last_name FROM customers"""),
)
def mask_customers(spark, sf_dir):
    c = gold(spark, sf_dir).silver("customers")
    return c.select(
        "customer_id", mask_email("email").alias("email"), mask_phone("phone").alias("phone"),
        mask_string("first_name").alias("first_name"), mask_string("last_name", MASKED).alias("last_name"),
    )


@query(
    "policy_bronze_customers",
    sql("customers", body=f"""SELECT customer_id AS "CUSTOMER_ID", {_MASK_EMAIL.format('email')} AS "EMAIL",
        '***-***-' || right(phone, 4) AS "PHONE", '[REDACTED]' AS "FIRST_NAME", '[REDACTED]' AS "LAST_NAME" FROM customers"""),
)
def policy_bronze_customers(spark, sf_dir):
    # bronze columns are upper case
    c = gold(spark, sf_dir).silver("customers").select("customer_id", "email", "phone", "first_name", "last_name")
    return apply_policy(c.toDF(*[n.upper() for n in c.columns]), "Customers", ["analysts_na"])


@query(
    "policy_customers",
    sql("customers", body=f"""SELECT customer_id, {_MASK_EMAIL.format('email')} AS email,
        '***-***-' || right(phone, 4) AS phone, '[REDACTED]' AS first_name, '[REDACTED]' AS last_name, status
        FROM customers"""),
)
def policy_customers(spark, sf_dir):
    out = apply_policy(gold(spark, sf_dir).silver("customers"), "customers", ["analysts_na"])
    return out.select("customer_id", "email", "phone", "first_name", "last_name", "status")


@query(
    "policy_sales_dashboard",
    sql(*_DASHBOARD_TABLES, body=f"""SELECT * REPLACE (CASE WHEN customer_name IS NOT NULL THEN '***MASKED***' END AS customer_name)
        FROM ({_DASHBOARD_SQL})"""),
)
def policy_sales_dashboard(spark, sf_dir):
    # the mart states no class; its customer name has one by lineage
    g = gold(spark, sf_dir)
    mart = views.vw_sales_dashboard(g.fact("fact_sales"), g.dims())
    return plain(apply_policy(mart, "vw_sales_dashboard", ["analysts_na"], g.policy))


@query(
    "policy_dim_location",
    sql("dim_location", body="""SELECT * REPLACE (CASE WHEN postal_code IS NOT NULL THEN '[REDACTED]' END AS postal_code)
        FROM dim_location"""),
)
def policy_dim_location(spark, sf_dir):
    g = gold(spark, sf_dir)
    d = g.dim("dim_location").drop("_created_date", "_last_modified_date", "_pipeline_run_id")
    return apply_policy(d, "dim_location", [], g.policy)


@query(
    "row_filter_locations",
    sql("dim_location", body="SELECT * FROM dim_location WHERE state IN ('ASIA', 'EUROPE')"),
)
def row_filter_locations(spark, sf_dir):
    d = gold(spark, sf_dir).dim("dim_location").drop("_created_date", "_last_modified_date", "_pipeline_run_id")
    return row_filter(d, "state", ["g_asia", "g_europe"], {"g_asia": "ASIA", "g_europe": "EUROPE", "g_africa": "AFRICA"})


# -- lineage ------------------------------------------------------------------------------------------------------

_EDGE_SQL = """
    edges AS (
      SELECT DISTINCT 'line:' || l_orderkey || ':' || l_linenumber AS node, 'order:' || l_orderkey AS depends_on FROM lineitem
      UNION SELECT 'line:' || l_orderkey || ':' || l_linenumber, 'part:' || l_partkey FROM lineitem
      UNION SELECT 'order:' || o_orderkey, 'customer:' || o_custkey FROM orders
      UNION SELECT 'order:' || o_orderkey, 'address:' || o_custkey FROM orders
      UNION SELECT 'address:' || c_custkey, 'customer:' || c_custkey FROM customer
      UNION SELECT 'address:' || c_custkey, 'city:' || c_nationkey FROM customer
      UNION SELECT 'part:' || p_partkey, 'brand:' || p_brand FROM part),
    nodes AS (SELECT node FROM edges UNION SELECT depends_on FROM edges),
    walk AS (
      SELECT node, 0 AS level FROM nodes WHERE node NOT IN (SELECT node FROM edges)
      UNION SELECT e.node, w.level + 1 FROM edges e JOIN walk w ON e.depends_on = w.node)"""


def _record_edges(raw):
    """Record-level dependencies of the sales data, in the shape of the table-level dependency graph."""
    line = F.concat(F.lit("line:"), "l_orderkey", F.lit(":"), "l_linenumber")

    def edges(df, node, *parents):
        return df.select(node.alias("node"), F.explode(F.array(*parents)).alias("depends_on"))

    def ident(kind, col):
        return F.concat(F.lit(f"{kind}:"), col)

    # a table is read once for all its kinds of edges, so that the edges of a record stay together
    li, o, c, p = (raw.table(t) for t in ("lineitem", "orders", "customer", "part"))
    return (
        edges(li, line, ident("order", "l_orderkey"), ident("part", "l_partkey"))
        .unionByName(edges(o, ident("order", "o_orderkey"), ident("customer", "o_custkey"), ident("address", "o_custkey")))
        .unionByName(edges(c, ident("address", "c_custkey"), ident("customer", "c_custkey"), ident("city", "c_nationkey")))
        .unionByName(edges(p, ident("part", "p_partkey"), ident("brand", "p_brand")))
    )


@query("dependency_levels", f"WITH RECURSIVE {_EDGE_SQL} SELECT node, max(level) AS level FROM walk GROUP BY 1")
def record_levels(spark, sf_dir):
    return dependency_levels(None, _record_edges(gold(spark, sf_dir).raw))  # both ends of every edge are nodes


# -- sinks --------------------------------------------------------------------------------------------------------

@query(
    "sink_partition_overwrite",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders,
       round(sum(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 2 ELSE 1 END * CAST(o_totalprice AS DECIMAL(15,2)))::DOUBLE, 2)
         AS total FROM orders GROUP BY 1""",
)
def sink_partition_overwrite(spark, sf_dir):
    o = gold(spark, sf_dir).raw.table("orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    path = scratch_path(spark, "orders")
    write_table(o, path, partition_by=["month"], cluster_by=["o_custkey"])
    # the months from 2000 on are loaded again with doubled prices; all others must stay
    again = o.filter("month >= '2000-01'").withColumn("price", (F.col("price") * 2).cast("decimal(15,2)"))
    overwrite_partitions(again, path, ["month"])
    back = spark.read.parquet(path)
    return plain(
        back.groupBy(F.col("month").cast("string").alias("month")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total")
        )
    )


@query(
    "sink_interleaved_layout",
    """SELECT 'o_custkey' AS filtered, count(*) AS n, 1 AS bounded FROM orders
         WHERE o_custkey >= (SELECT quantile_disc(o_custkey, 0.45) FROM orders) AND o_custkey <= (SELECT quantile_disc(o_custkey, 0.5) FROM orders)
       UNION ALL SELECT 'o_totalprice', count(*), 1 FROM orders
         WHERE o_totalprice >= (SELECT quantile_disc(o_totalprice, 0.45) FROM orders)
           AND o_totalprice <= (SELECT quantile_disc(o_totalprice, 0.5) FROM orders)""",
)
def sink_interleaved_layout(spark, sf_dir):
    # a twentieth of the values of either column stands in at most half of the 64 files
    o = gold(spark, sf_dir).raw.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = scratch_path(spark, "orders")
    write_table(o, path, cluster_by=["o_custkey", "o_totalprice"], files=64)
    back = spark.read.parquet(path)
    out = []
    for c in ("o_custkey", "o_totalprice"):
        found = aggregates.exact_quantiles(back, c, (0.45, 0.5)).scalar()
        low, high = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        hit = F.col(c).between(low, high)
        files = back.withColumn("_file", F.input_file_name()).groupBy("_file").agg(F.count_if(hit).alias("n"))
        out.append(
            files.agg(F.sum("n").alias("n"), (F.count_if(F.col("n") > 0) <= F.count(F.lit(1)) / 2).cast("int").alias("bounded")).select(
                F.lit(c).alias("filtered"), "n", "bounded"
            )
        )
    return out[0].unionByName(out[1])


@query(
    "reconcile_ranges",
    """SELECT o_orderkey, 'changed' AS status, 1::BIGINT AS n_left, 1::BIGINT AS n_right FROM orders WHERE o_orderkey < 300
       UNION ALL SELECT o_orderkey, 'missing', 1, 0 FROM orders WHERE o_orderkey BETWEEN 300 AND 500
       UNION ALL SELECT o_orderkey + 10000000000, 'extra', 0, 1 FROM orders WHERE o_orderstatus = 'P'""",
)
def reconcile_orders(spark, sf_dir):
    # a copy of orders with repriced and lost orders in a few ranges, and strange ones behind all others
    o = gold(spark, sf_dir).raw.table("orders")
    price = F.when(F.col("o_orderkey") < 300, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = o.filter("o_orderkey not between 300 and 500").withColumn("o_totalprice", price)
    strange = o.filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(10**10))
    return reconcile_ranges(o, copy.unionByName(strange), "o_orderkey")


@query(
    "sink_append_quarantine",
    sql("headers_std", "surveys_std", body="""SELECT 'orders' AS source, count(*) AS n FROM headers_std
        WHERE customer_id IS NULL OR NOT total_amount > 0
        UNION ALL SELECT 'surveys', count(*) FROM surveys_std
        WHERE nps_score > 10 OR csat_score NOT BETWEEN 1 AND 5"""),
)
def sink_append_quarantine(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    path = scratch_path(spark, "quarantine")
    for label, name in (("orders", "oe_order_headers_all"), ("surveys", "surveys")):
        bad = q.quarantined_rows(s.checked(name))
        append_table(bad.select(F.lit(label).alias("source"), F.to_json(F.struct("*")).alias("row_data")), path)
    return spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


# -- streaming ----------------------------------------------------------------------------------------------------

def _event_files(g, name: str):
    """All events as several files, so that a stream sees more than one micro-batch."""
    path = scratch_path(g.spark, name)
    g.raw.table("events").repartitionByRange(4, "event_id").write.parquet(path)
    return path, g.raw.table("events").schema


@query(
    "stream_bronze_ingest",
    "SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1",
)
def stream_bronze_ingest(spark, sf_dir):
    g = gold(spark, sf_dir)
    path, schema = _event_files(g, "landing")
    out = scratch_path(spark, "bronze")
    stream = jobs.dedupe_appends(jobs.read_files(spark, path, schema, 2), ["event_id"], "ts", "40 days")
    jobs.stream_bronze(stream, out, scratch_path(spark, "checkpoint")).awaitTermination()
    back = spark.read.parquet(out)
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query(
    "stream_changes_scd1",
    sql("feed_last", body="""SELECT "CUSTOMER_ID", ver AS _cdc_version, CAST(op = 'D' AS INTEGER) AS _is_deleted,
        CASE WHEN op <> 'D' THEN "NAME" END AS "NAME" FROM feed_last"""),
)
def stream_changes_scd1(spark, sf_dir):
    g = gold(spark, sf_dir)
    path = scratch_path(spark, "changes")
    feed = g.raw.change_feed().drop("_cdc_operation")
    feed.repartitionByRange(4, F.desc("SYS_CHANGE_VERSION")).write.parquet(path)
    state = PartitionedState(spark, scratch_path(spark, "state"), jobs.BUCKET)
    stream = jobs.read_files(spark, path, feed.schema, 2)
    jobs.stream_apply_changes(
        stream, state, scratch_path(spark, "checkpoint"), ["CUSTOMER_ID"], "SYS_CHANGE_VERSION", buckets=8
    ).awaitTermination()
    out = state.read()
    name = F.when(~F.col("_is_deleted"), F.col("NAME")).alias("NAME")
    return plain(out.select("CUSTOMER_ID", "_cdc_version", "_is_deleted", name))


@query(
    "stream_changes_scd2",
    """SELECT user_id, kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _valid_from,
              CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) AS INTEGER) AS _version
       FROM (SELECT user_id, ts, event_type AS kind, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before
             FROM events) WHERE before IS NULL OR before <> kind""",
)
def stream_changes_scd2(spark, sf_dir):
    g = gold(spark, sf_dir)
    path = scratch_path(spark, "changes")
    changes = g.raw.table("events").selectExpr("user_id", "event_id", "event_type as kind", "ts")
    for half in ("ts >= '2024-01-16'", "ts < '2024-01-16'"):  # the later half arrives first
        changes.filter(half).coalesce(1).write.mode("append").parquet(path)
    state = PartitionedState(spark, scratch_path(spark, "state"), jobs.BUCKET)
    jobs.stream_apply_changes(
        jobs.read_files(spark, path, changes.schema, 1), state, scratch_path(spark, "checkpoint"), ["user_id"],
        "event_id", scd=2, tracked=["kind"], event_time="ts", buckets=8,
    ).awaitTermination()
    return plain(shown_versions(state.read()).select("user_id", "kind", "_valid_from", "_version"))


@query(
    "stream_quality_split",
    sql("surveys_std", body="""SELECT CAST(nps_score > 10 OR csat_score NOT BETWEEN 1 AND 5 AS INTEGER) AS quarantined,
        count(*) AS n, CAST(sum(survey_id) AS BIGINT) AS id_sum FROM surveys_std GROUP BY 1"""),
)
def stream_quality_split(spark, sf_dir):
    g = gold(spark, sf_dir)
    path = scratch_path(spark, "surveys")
    surveys = g.silver.standardised("surveys")
    surveys.repartitionByRange(4, "survey_id").write.parquet(path)
    out = scratch_path(spark, "checked")
    jobs.stream_quality(
        jobs.read_files(spark, path, surveys.schema, 2), out, scratch_path(spark, "checkpoint"), SILVER_DQ["surveys"],
        fail_limit=0.05, key="survey_id",
    ).awaitTermination()
    parts = [
        jobs.read_quality(spark, out, side).agg(
            F.lit(int(side)).alias("quarantined"), F.count(F.lit(1)).alias("n"), F.sum("survey_id").alias("id_sum")
        )
        for side in (False, True)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "stream_gold_interactions",
    sql("fact_interactions", body="""SELECT interaction_year_month, count(*) AS n,
        count(*) FILTER (WHERE dim_customer_key = -1) AS unknown, CAST(sum(interaction_id) AS BIGINT) AS id_sum
        FROM fact_interactions GROUP BY 1"""),
)
def stream_gold_interactions(spark, sf_dir):
    g = gold(spark, sf_dir)
    path = scratch_path(spark, "interactions")
    rows = g.silver("interactions")
    rows.repartitionByRange(4, "interaction_id").write.parquet(path)
    incidents, customers = g.silver("incidents"), g.dim("dim_customer")
    state = PartitionedState(spark, scratch_path(spark, "fact"), "interaction_year_month")
    jobs.stream_gold(
        jobs.read_files(spark, path, rows.schema, 2), state, scratch_path(spark, "checkpoint"), "interaction_id",
        lambda batch: facts.build_fact_interactions(batch, incidents, customers),
    ).awaitTermination()
    return state.read().groupBy("interaction_year_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("dim_customer_key") == UNKNOWN_KEY).alias("unknown"),
        F.sum("interaction_id").alias("id_sum"),
    )


@query(
    "stream_gold_orders",
    """SELECT CAST(strftime(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate END,
              '%Y%m') AS INTEGER) AS m, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS id_sum FROM orders GROUP BY 1""",
)
def stream_gold_orders(spark, sf_dir):
    # some eighty month partitions; the last file moves the urgent orders by a month
    g = gold(spark, sf_dir)
    path = scratch_path(spark, "orders")
    day = F.col("o_orderdate")
    rows = g.raw.table("orders").select("o_orderkey", "o_orderpriority", year_month(day).alias("m"), day.alias("day"))
    rows.repartitionByRange(4, "o_orderkey").write.parquet(path)
    moved = rows.filter("o_orderpriority = '1-URGENT'").withColumn("m", year_month(F.add_months("day", 1)))
    moved.coalesce(1).write.mode("append").parquet(path)
    state = PartitionedState(spark, scratch_path(spark, "fact"), "m")
    jobs.stream_gold(
        jobs.read_files(spark, path, rows.schema, 2), state, scratch_path(spark, "checkpoint"), "o_orderkey", lambda batch: batch
    ).awaitTermination()
    return state.read().groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("id_sum"))
