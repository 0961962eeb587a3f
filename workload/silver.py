"""Bronze and silver queries: standardised entities, rules, deduplication, merges, quality."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.exprs import change_hash, hash_key, nps_category, year_month, year_month_text
from tidemark.operators import quality as q
from tidemark.operators.contracts import key_issues
from tidemark.operators.history import (
    chain_versions, fold_events, initial_versions, late_changes, scd2, scd2_feed, shown_versions,
)
from tidemark.operators.joins import asof_join, orphans, with_parent
from tidemark.operators.keys import assign_keys
from tidemark.operators.latest import cdc_latest, keep_latest
from tidemark.operators.merge import Clause, apply_cdc, delete_where, merge, merge_fact, missing_keys, scd1
from tidemark.operators.rules import add_ingest_metadata, add_silver_metadata, apply_rules, rule
from tidemark.operators.runlog import batch_version, load_health, table_state
from tidemark.plans import facts
from tidemark.plans.entities import standardise
from tidemark.plans.quality_rules import (
    CUSTOMER_LOAD_RULES, GOLD_DQ, ORDER_LOAD_RULES, REFERENTIAL, SILVER_DQ,
)
from tidemark.sources.increments import cdc_changes, read_increment
from tidemark.session import durable
from workload.model import gold, plain, r4
from workload.sql_entities import sql

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
QUERIES: list[tuple] = []


def query(name: str, statement: str | None):
    def register(fn):
        QUERIES.append((name, fn, statement))
        return fn

    return register


def ts(col: str, alias: str | None = None) -> str:
    return f"{TS.format(col)} AS {alias or col}"


# -- standardised entities ---------------------------------------------------------------------------------------

_ENTITY_SQL = {
    "customers": ("customers", f"""customer_id, email, phone, first_name, last_name, gender, customer_type, status,
        CAST(marketing_opt_in AS INTEGER) AS marketing_opt_in, {ts('registration_date')}, {ts('last_update_date')}"""),
    "customer_registration_source": ("crs", f"""registration_source_id, customer_id, channel, campaign_id, utm_source,
        utm_medium, utm_campaign, device_type, {ts('registration_date')}"""),
    "oe_order_headers_all": ("headers_std", f"""order_id, order_number, customer_id, {ts('order_date')}, order_status,
        CAST(subtotal_amount AS DOUBLE) AS subtotal_amount, CAST(discount_amount AS DOUBLE) AS discount_amount,
        CAST(tax_amount AS DOUBLE) AS tax_amount, CAST(shipping_amount AS DOUBLE) AS shipping_amount,
        CAST(total_amount AS DOUBLE) AS total_amount, shipping_address_id, {ts('delivered_date')}, order_source,
        {ts('order_date', 'last_update_date')}, _order_year_month"""),
    "oe_order_lines_all": ("lines_std", f"""line_id, order_id, product_id, quantity,
        CAST(unit_price_d AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total, {ts('last_update_date')}"""),
    "addresses": ("addresses", "*"),
    "city_tier_master": ("tiers", "*"),
    "mtl_system_items_b": ("items", """inventory_item_id, category_id, brand_id, sku, product_name,
        CAST(unit_cost AS DOUBLE) AS unit_cost"""),
    "categories": ("categories", "*"),
    "brands": ("brands", "*"),
    "marketing_campaigns": ("campaigns", """campaign_id, campaign_name, campaign_code, channel, sub_channel, start_date,
        end_date, CAST(total_spend AS DOUBLE) AS total_spend, customers_acquired, status"""),
    "incidents": ("incidents", f"incident_id, customer_id, order_id, status, priority, {ts('created_date')}"),
    "interactions": ("interactions_std", f"""interaction_id, incident_id, interaction_type, {ts('interaction_date')},
        notes"""),
    "surveys": ("surveys_std", f"""survey_id, customer_id, order_id, incident_id, survey_type, nps_score, csat_score,
        CAST(NULL AS VARCHAR) AS nps_category, {ts('response_date')}"""),
}


def _entity(name: str):
    def run(spark, sf_dir):
        out = gold(spark, sf_dir).silver.standardised(name)
        return plain(out.drop("_segment", "_cdc_operation", "_ingest_timestamp"))

    return run


for _name, (_cte, _cols) in _ENTITY_SQL.items():
    query(f"silver_{_name}", sql(_cte, body=f"SELECT {_cols} FROM {_cte}"))(_entity(_name))


# -- rules, metadata, expressions --------------------------------------------------------------------------------

@query(
    "rule_chain",
    sql("feed", body="""
        SELECT "CUSTOMER_ID" AS customer_id, upper(trim("NAME")) AS label, coalesce(amt, 0) AS amount, kind
        FROM (SELECT *, CAST(floor("AMOUNT") AS INTEGER) AS amt, lower(op) AS kind FROM feed
              QUALIFY row_number() OVER (PARTITION BY "CUSTOMER_ID" ORDER BY ver DESC) = 1)
        WHERE kind <> 'd'"""),
)
def rule_chain(spark, sf_dir):
    df = gold(spark, sf_dir).raw.change_feed().withColumnRenamed("SYS_CHANGE_VERSION", "_cdc_version")
    rules = [
        rule("FILTER", expression="kind <> 'd'", seq=90),
        rule("DEDUPE", "CUSTOMER_ID", seq=10),
        rule("LOWER", "SYS_CHANGE_OPERATION", "kind", seq=20),
        rule("TRIM", "NAME", "label", seq=30),
        rule("UPPER", "label", "label", seq=40),
        rule("EXPRESSION", None, "amt", "floor(AMOUNT)", seq=50),
        rule("CAST", "amt", "amt", "int", seq=60),
        rule("COALESCE", "amt", "amount", "0", seq=70),
        rule("RENAME", "CUSTOMER_ID", "customer_id", seq=80),
        rule("TRANSFORM", None, "amount", "cast(null as int)", seq=75, active=False),
    ]
    return apply_rules(df, rules).select("customer_id", "label", "amount", "kind")


@query(
    "bronze_metadata",
    sql("feed", body="""SELECT "CUSTOMER_ID", ver AS "SYS_CHANGE_VERSION", op AS _cdc_operation, 'CRM' AS _source_system,
        'run-1' AS _pipeline_run_id, '2024-02-01' AS ingest_date FROM feed"""),
)
def bronze_metadata(spark, sf_dir):
    feed = gold(spark, sf_dir).raw.change_feed()
    out = add_ingest_metadata(feed, "run-1", "crm", now=datetime(2024, 2, 1))
    return out.select(
        "CUSTOMER_ID", "SYS_CHANGE_VERSION", "_cdc_operation", "_source_system", "_pipeline_run_id", "ingest_date"
    )


@query(
    "silver_metadata",
    sql("feed", body="""SELECT "CUSTOMER_ID", ver AS "SYS_CHANGE_VERSION", 'run-1' AS _pipeline_run_id,
        CAST(op = 'D' AS INTEGER) AS _is_deleted FROM feed"""),
)
def silver_metadata(spark, sf_dir):
    out = add_silver_metadata(gold(spark, sf_dir).raw.change_feed(), "run-1", datetime(2024, 2, 1))
    return plain(out.select("CUSTOMER_ID", "SYS_CHANGE_VERSION", "_pipeline_run_id", "_is_deleted"))


@query(
    "derived_months",
    sql("headers", body="""SELECT _order_year_month, CAST(strftime(order_date, '%Y%m') AS INTEGER) AS order_year_month,
        count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS total_amount FROM headers GROUP BY 1, 2"""),
)
def derived_months(spark, sf_dir):
    h = gold(spark, sf_dir).silver("oe_order_headers_all")
    keys = [year_month_text("order_date").alias("_order_year_month"), year_month("order_date").alias("order_year_month")]
    return plain(h.groupBy(*keys).agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("total_amount")))


@query(
    "nps_categories",
    sql("surveys", body="""SELECT CASE WHEN nps_score <= 6 THEN 'Detractor' WHEN nps_score <= 8 THEN 'Passive'
        ELSE 'Promoter' END AS nps_category, count(*) AS surveys FROM surveys GROUP BY 1"""),
)
def nps_categories(spark, sf_dir):
    s = gold(spark, sf_dir).silver("surveys")
    return s.groupBy(nps_category("nps_score").alias("nps_category")).agg(F.count(F.lit(1)).alias("surveys"))


@query(
    "revenue_orders",
    sql("headers", body="""SELECT order_id, order_status, CAST(total_amount AS DOUBLE) AS total_amount FROM headers
        WHERE order_status NOT IN ('CANCELLED', 'RETURNED')"""),
)
def revenue_orders(spark, sf_dir):
    h = gold(spark, sf_dir).silver("oe_order_headers_all")
    return plain(facts.revenue_orders(h).select("order_id", "order_status", "total_amount"))


@query(
    "order_rule_violations",
    sql("headers_std", body="""
        SELECT * FROM (SELECT order_id,
          CAST(total_amount <> subtotal_amount - discount_amount + tax_amount + shipping_amount AS INTEGER)
            AS amount_mismatch,
          CAST(order_status = 'DELIVERED' AND delivered_date IS NULL AS INTEGER) AS delivered_date_missing
        FROM headers_std) WHERE amount_mismatch = 1 OR delivered_date_missing = 1"""),
)
def order_rule_violations(spark, sf_dir):
    h = gold(spark, sf_dir).silver.standardised("oe_order_headers_all")
    return plain(facts.order_rule_violations(h).select("order_id", "amount_mismatch", "delivered_date_missing"))


# -- deduplication, keys ------------------------------------------------------------------------------------------

@query(
    "keep_latest_lines",
    sql("lines_std", body=f"""SELECT line_id, order_id, product_id, quantity, CAST(line_total AS DOUBLE) AS line_total,
        {ts('last_update_date')} FROM lines_std"""),
)
def keep_latest_lines(spark, sf_dir):
    lines = gold(spark, sf_dir).silver.standardised("oe_order_lines_all")
    return plain(lines.select("line_id", "order_id", "product_id", "quantity", "line_total", "last_update_date"))


@query(
    "cdc_dedupe",
    sql("feed_last", body="""SELECT "CUSTOMER_ID", ver AS "SYS_CHANGE_VERSION", op AS "SYS_CHANGE_OPERATION", "NAME"
        FROM feed_last"""),
)
def cdc_dedupe(spark, sf_dir):
    feed = gold(spark, sf_dir).raw.change_feed()
    return cdc_latest(feed, ["CUSTOMER_ID"]).select(
        "CUSTOMER_ID", "SYS_CHANGE_VERSION", "SYS_CHANGE_OPERATION", "NAME"
    )


@query(
    "any_row_per_key",
    sql("lines_std", body="SELECT DISTINCT l_orderkey * 10 + l_linenumber AS line_id FROM lineitem"),
)
def any_row_per_key(spark, sf_dir):
    lines = gold(spark, sf_dir).raw.table("lineitem").selectExpr("l_orderkey * 10 + l_linenumber as line_id", "l_partkey")
    return keep_latest(lines, ["line_id"]).select("line_id")


@query(
    "surrogate_keys",
    "SELECT o_orderkey, 100 + row_number() OVER (ORDER BY o_orderkey) AS order_key FROM orders",
)
def surrogate_keys(spark, sf_dir):
    orders = gold(spark, sf_dir).raw.table("orders").select("o_orderkey", F.lit(None).cast("long").alias("order_key"))
    return assign_keys(orders, "o_orderkey", "order_key", 100)


@query(
    "surrogate_keys_text",
    """SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR) COLLATE "binary") AS order_key FROM orders""",
)
def surrogate_keys_text(spark, sf_dir):
    orders = gold(spark, sf_dir).raw.table("orders").selectExpr("o_orderkey", "cast(o_orderkey as string) as name")
    keyed = assign_keys(orders.withColumn("order_key", F.lit(None).cast("long")), "name", "order_key")
    return keyed.select("o_orderkey", "order_key")


@query(
    "surrogate_keys_per_version",
    """SELECT user_id, event_id, row_number() OVER (ORDER BY user_id, event_id) AS version_key FROM events""",
)
def surrogate_keys_per_version(spark, sf_dir):
    from tidemark.operators import slices

    events = gold(spark, sf_dir).raw.table("events").select("user_id", "event_id", "ts")
    # event ids follow time, so day slices of the time also order them
    numbered = slices.running_count(
        slices.with_slice(events, slices.step_slice("event_id", 65_536)), ["user_id"], ["event_id"], "n"
    ).withColumn("version_key", F.lit(None).cast("long"))
    return assign_keys(numbered, "user_id", "version_key", 0, "n").select("user_id", "event_id", "version_key")


@query(
    "hash_keys",
    sql("dim_customer", body="""SELECT md5(customer_id || '||' || strftime(_valid_from, '%Y-%m-%d %H:%M:%S')) AS customer_sk,
        customer_id, _version FROM dim_customer"""),
)
def hash_keys(spark, sf_dir):
    d = gold(spark, sf_dir).dim("dim_customer")
    return d.select(hash_key("customer_id", "_valid_from").alias("customer_sk"), "customer_id", "_version")


@query(
    "change_hashes",
    sql("customers", body="""SELECT customer_id, md5(coalesce(status, chr(0)) || '||' || customer_type || '||' ||
        CAST(marketing_opt_in AS VARCHAR)) AS hash_key FROM customers WHERE status IS NOT NULL
        UNION ALL SELECT customer_id, NULL FROM customers WHERE status IS NULL"""),
)
def change_hashes(spark, sf_dir):
    c = gold(spark, sf_dir).silver.standardised("customers")
    h = change_hash("status", "customer_type", "marketing_opt_in")
    # rows with a null status carry the null mark, whose hash SQL engines spell differently
    return c.select("customer_id", F.when(F.col("status").isNotNull(), h).alias("hash_key"))


# -- change feeds and merges --------------------------------------------------------------------------------------

@query(
    "change_feed_build",
    sql("feed", "accounts", body="""SELECT f."CUSTOMER_ID", f.ver AS "SYS_CHANGE_VERSION", f.op AS "SYS_CHANGE_OPERATION",
        a."NAME", CAST(a."AMOUNT" AS DOUBLE) AS "AMOUNT", CAST(77 AS BIGINT) AS _current_sync_version
        FROM feed f LEFT JOIN accounts a USING ("CUSTOMER_ID")"""),
)
def change_feed_build(spark, sf_dir):
    raw = gold(spark, sf_dir).raw
    feed = raw.change_feed().select("CUSTOMER_ID", "SYS_CHANGE_VERSION", "SYS_CHANGE_OPERATION")
    return plain(cdc_changes(feed, raw.accounts().drop("_cdc_operation"), ["CUSTOMER_ID"], 77))


@query("batch_version", "SELECT max(event_id) AS sync_version FROM events")
def new_sync_version(spark, sf_dir):
    return batch_version(gold(spark, sf_dir).raw.change_feed(), "SYS_CHANGE_VERSION")


@query(
    "incremental_extract",
    """SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events
       WHERE ts > TIMESTAMP '2024-01-10' - INTERVAL 2 DAY AND ts <= TIMESTAMP '2024-01-20'""",
)
def incremental_extract(spark, sf_dir):
    events = gold(spark, sf_dir).raw.table("events")
    got = read_increment(events, "ts", datetime(2024, 1, 10), datetime(2024, 1, 20), timedelta(days=2))
    return got.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


_CDC_HARD = """
    SELECT coalesce(a."CUSTOMER_ID", f."CUSTOMER_ID") AS "CUSTOMER_ID",
           CASE WHEN f.op IS NULL THEN a."NAME" ELSE f."NAME" END AS "NAME",
           CAST(CASE WHEN f.op IS NULL THEN a."AMOUNT" ELSE f."AMOUNT" END AS DOUBLE) AS "AMOUNT",
           coalesce(f.op, 'I') AS _cdc_operation, f.ver AS _cdc_version
    FROM accounts a FULL JOIN feed_last f ON a."CUSTOMER_ID" = f."CUSTOMER_ID"
    WHERE f.op IS NULL OR f.op <> 'D'"""


@query("cdc_apply_hard_delete", sql("accounts", "feed_last", body=_CDC_HARD))
def cdc_hard(spark, sf_dir):
    raw = gold(spark, sf_dir).raw
    out = apply_cdc(raw.accounts(), raw.change_feed(), ["CUSTOMER_ID"])
    return plain(out.select("CUSTOMER_ID", "NAME", "AMOUNT", "_cdc_operation", "_cdc_version"))


@query(
    "cdc_apply_soft_delete",
    sql("accounts", "feed_last", body="""
        SELECT coalesce(a."CUSTOMER_ID", f."CUSTOMER_ID") AS "CUSTOMER_ID",
               CASE WHEN f.op IS NULL OR f.op = 'D' THEN a."NAME" ELSE f."NAME" END AS "NAME",
               CAST(coalesce(f.op = 'D', false) AS INTEGER) AS _is_deleted, f.ver AS _cdc_version
        FROM accounts a FULL JOIN feed_last f ON a."CUSTOMER_ID" = f."CUSTOMER_ID"
        WHERE a."CUSTOMER_ID" IS NOT NULL OR f.op <> 'D'"""),
)
def cdc_soft(spark, sf_dir):
    raw = gold(spark, sf_dir).raw
    out = apply_cdc(raw.accounts(), raw.change_feed(), ["CUSTOMER_ID"], delete="soft")
    return plain(out.select("CUSTOMER_ID", "NAME", "_is_deleted", "_cdc_version"))


@query(
    "keyed_merge",
    sql("accounts", "feed_last", body="""
        SELECT coalesce(a."CUSTOMER_ID", f."CUSTOMER_ID") AS "CUSTOMER_ID",
               CASE WHEN a."CUSTOMER_ID" IS NULL THEN f."NAME" WHEN f.op = 'U' THEN a."NAME" || ' / ' || f."NAME"
                    ELSE a."NAME" END AS "NAME",
               CAST(CASE WHEN a."CUSTOMER_ID" IS NULL THEN f."AMOUNT" WHEN f.op = 'I' THEN a."AMOUNT" + f."AMOUNT"
                    ELSE a."AMOUNT" END AS DOUBLE) AS "AMOUNT"
        FROM accounts a FULL JOIN feed_last f ON a."CUSTOMER_ID" = f."CUSTOMER_ID"
        WHERE CASE WHEN a."CUSTOMER_ID" IS NULL THEN f.op <> 'D'
              ELSE NOT (f.op IS NOT NULL AND f.op = 'D' AND a."AMOUNT" < 5000) END"""),
)
def keyed_merge(spark, sf_dir):
    raw = gold(spark, sf_dir).raw
    source = cdc_latest(raw.change_feed(), ["CUSTOMER_ID"])
    out = merge(
        raw.accounts(), source, ["CUSTOMER_ID"],
        [
            Clause("delete", "s.SYS_CHANGE_OPERATION = 'D' and t.AMOUNT < 5000"),
            Clause("update", "s.SYS_CHANGE_OPERATION = 'U'", {"NAME": "concat(t.NAME, ' / ', s.NAME)"}),
            Clause("update", "s.SYS_CHANGE_OPERATION = 'I'", {"AMOUNT": "t.AMOUNT + s.AMOUNT"}),
            Clause("insert", "s.SYS_CHANGE_OPERATION <> 'D'"),
        ],
    )
    return plain(out.select("CUSTOMER_ID", "NAME", "AMOUNT"))


@query(
    "scd1_upsert",
    sql("accounts", "feed_last", body="""
        SELECT "CUSTOMER_ID", "NAME", CAST("AMOUNT" AS DOUBLE) AS "AMOUNT" FROM accounts
        WHERE "CUSTOMER_ID" NOT IN (SELECT "CUSTOMER_ID" FROM feed_last)
        UNION ALL SELECT "CUSTOMER_ID", "NAME", CAST("AMOUNT" AS DOUBLE) FROM feed_last"""),
)
def scd1_upsert(spark, sf_dir):
    raw = gold(spark, sf_dir).raw
    source = cdc_latest(raw.change_feed(), ["CUSTOMER_ID"]).select("CUSTOMER_ID", "NAME", "AMOUNT")
    return plain(scd1(raw.accounts().drop("_cdc_operation"), source, ["CUSTOMER_ID"]))


_TRACKED = ["status", "customer_type", "marketing_opt_in"]


@query(
    "scd2_initial",
    sql("customers", body=f"""SELECT customer_id, status, {ts('last_update_date', '_valid_from')}, 1 AS _is_current,
        1 AS _version FROM customers"""),
)
def scd2_initial(spark, sf_dir):
    c = gold(spark, sf_dir).silver("customers")
    out = initial_versions(c, _TRACKED, "last_update_date")
    return plain(out.select("customer_id", "status", "_valid_from", "_is_current", "_version"))


_SCD2 = f"""
    SELECT a.customer_id, a.email, a.status, {ts('a.last_update_date', '_valid_from')},
           CASE WHEN a.status IS DISTINCT FROM b.status THEN {TS.format('b.last_update_date')} END AS _valid_to,
           CAST(a.status IS NOT DISTINCT FROM b.status AS INTEGER) AS _is_current, 1 AS _version
    FROM customers a JOIN customers_v2 b USING (customer_id)
    UNION ALL
    SELECT b.customer_id, b.email, b.status, {TS.format('b.last_update_date')}, NULL, 1, 2
    FROM customers a JOIN customers_v2 b USING (customer_id) WHERE a.status IS DISTINCT FROM b.status"""
_SCD2_COLS = ("customer_id", "email", "status", "_valid_from", "_valid_to", "_is_current", "_version")


def _scd2_once(spark, sf_dir, overwrite=()):
    g = gold(spark, sf_dir)
    first = scd2(None, g.silver("customers"), ["customer_id"], _TRACKED, "last_update_date")
    return g, scd2(first, g.customers_v2(), ["customer_id"], _TRACKED, "last_update_date", overwrite)


@query("scd2_merge", sql("customers", "customers_v2", body=_SCD2))
def scd2_merge(spark, sf_dir):
    return plain(_scd2_once(spark, sf_dir)[1].select(*_SCD2_COLS))


@query("scd2_merge_twice", sql("customers", "customers_v2", body=_SCD2))
def scd2_merge_twice(spark, sf_dir):
    g, once = _scd2_once(spark, sf_dir)
    again = scd2(once, g.customers_v2(), ["customer_id"], _TRACKED, "last_update_date")
    return plain(again.select(*_SCD2_COLS))


@query(
    "scd2_hybrid_type1",
    sql("customers", "customers_v2", body=_SCD2.replace("a.email", "b.email")),
)
def scd2_hybrid(spark, sf_dir):
    return plain(_scd2_once(spark, sf_dir, ["email"])[1].select(*_SCD2_COLS))


@query(
    "scd2_late_changes",
    sql("customers", "customers_v2", body="""SELECT a.customer_id FROM customers a JOIN customers_v2 b USING (customer_id)
        WHERE a.status IS DISTINCT FROM b.status"""),
)
def scd2_late(spark, sf_dir):
    # the first extract arrives again after the second one
    g, once = _scd2_once(spark, sf_dir)
    return late_changes(once, g.silver("customers"), ["customer_id"], _TRACKED, "last_update_date").select("customer_id")


_CHAIN = """
    SELECT user_id, kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _valid_from,
           strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S') AS _valid_to,
           CAST(lead(ts) OVER w IS NULL AS INTEGER) AS _is_current, CAST(row_number() OVER w AS INTEGER) AS _version
    FROM (SELECT user_id, ts, event_type AS kind, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before
          FROM events)
    WHERE before IS NULL OR before <> kind
    WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""
_CHAIN_COLS = ("user_id", "kind", "_valid_from", "_valid_to", "_is_current", "_version")


def _event_changes(g):
    return g.raw.table("events").selectExpr("user_id", "event_id", "event_type as kind", "ts")


@query("scd2_many_changes", _CHAIN)
def scd2_many_changes(spark, sf_dir):
    out = chain_versions(_event_changes(gold(spark, sf_dir)), ["user_id"], ["kind"], "ts", ["event_id"])
    return plain(out.select(*_CHAIN_COLS))


@query("scd2_two_feeds", _CHAIN)
def scd2_two_feeds(spark, sf_dir):
    changes = _event_changes(gold(spark, sf_dir))
    first = scd2_feed(None, changes.filter("ts < '2024-01-16'"), ["user_id"], ["kind"], "ts", ["event_id"])
    out = scd2_feed(first, changes.filter("ts >= '2024-01-16'"), ["user_id"], ["kind"], "ts", ["event_id"])
    return plain(shown_versions(out).select(*_CHAIN_COLS))


@query("scd2_late_feed", _CHAIN)
def scd2_late_feed(spark, sf_dir):
    # both parts cover all days; the later half of the ids comes first
    changes = _event_changes(gold(spark, sf_dir))
    first = scd2_feed(None, changes.filter("event_id % 2 = 1"), ["user_id"], ["kind"], "ts", ["event_id"])
    out = scd2_feed(durable(first, "late"), changes.filter("event_id % 2 = 0"), ["user_id"], ["kind"], "ts", ["event_id"])
    return plain(shown_versions(out).select(*_CHAIN_COLS))


@query(
    "scd2_same_instant",
    _CHAIN.replace("FROM events)", """FROM (SELECT user_id, date_trunc('day', ts) AS ts, arg_max(event_type, event_id)
               AS event_type FROM events GROUP BY ALL))"""),
)
def scd2_same_instant(spark, sf_dir):
    # many events share a day; the one with the highest id counts, also when it arrives first
    changes = _event_changes(gold(spark, sf_dir)).withColumn("ts", F.date_trunc("day", "ts"))
    first = scd2_feed(None, changes.filter("event_id % 3 = 0"), ["user_id"], ["kind"], "ts", ["event_id"])
    out = scd2_feed(durable(first, "same"), changes.filter("event_id % 3 <> 0"), ["user_id"], ["kind"], "ts", ["event_id"])
    return plain(shown_versions(out).select(*_CHAIN_COLS))


_CHAIN_DELETES = """SELECT user_id, kind, _valid_from, _valid_to, _is_current,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY _valid_from) AS INTEGER) AS _version
    FROM (SELECT user_id, kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS _valid_from,
                 strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S') AS _valid_to,
                 CAST(lead(ts) OVER w IS NULL AS INTEGER) AS _is_current
          FROM (SELECT user_id, ts, event_type AS kind, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before
                FROM events)
          WHERE before IS NULL OR before <> kind WINDOW w AS (PARTITION BY user_id ORDER BY ts))
    WHERE kind <> 'error'"""


@query("scd2_deletes", _CHAIN_DELETES)
def scd2_deletes(spark, sf_dir):
    changes = _event_changes(gold(spark, sf_dir))
    gone = F.col("kind") == "error"
    first = scd2_feed(None, changes.filter("event_id % 2 = 1"), ["user_id"], ["kind"], "ts", ["event_id"], gone)
    out = scd2_feed(durable(first, "gone"), changes.filter("event_id % 2 = 0"), ["user_id"], ["kind"], "ts", ["event_id"], gone)
    return plain(shown_versions(out).select(*_CHAIN_COLS))


@query("scd2_retired", _CHAIN_DELETES)
def scd2_retired(spark, sf_dir):
    # what is hidden before the 16th is folded away before the rest arrives
    changes = _event_changes(gold(spark, sf_dir))
    gone, horizon = F.col("kind") == "error", F.lit("2024-01-16").cast("timestamp")
    first = scd2_feed(None, changes.filter(F.col("ts") < horizon), ["user_id"], ["kind"], "ts", ["event_id"], gone)
    first = durable(fold_events(durable(first, "events"), ["user_id"], horizon), "retired")
    out = scd2_feed(first, changes.filter(F.col("ts") >= horizon), ["user_id"], ["kind"], "ts", ["event_id"], gone)
    return plain(shown_versions(out).select(*_CHAIN_COLS))


@query(
    "scd2_null_event_time",
    sql("customers", "customers_v2", body=_SCD2.replace(
        "a.status IS DISTINCT FROM b.status", "(a.status IS DISTINCT FROM b.status AND a.customer_id % 3 <> 0)"
    ).replace("a.status IS NOT DISTINCT FROM b.status", "(a.status IS NOT DISTINCT FROM b.status OR a.customer_id % 3 = 0)")),
)
def scd2_null_event_time(spark, sf_dir):
    # a third of the changes has no event time; they are ignored, and the batch comes twice
    g = gold(spark, sf_dir)
    args = (["customer_id"], _TRACKED, "last_update_date")
    change = g.customers_v2().withColumn("last_update_date", F.when(F.col("customer_id") % 3 != 0, F.col("last_update_date")))
    once = scd2(scd2(None, g.silver("customers"), *args), change, *args)
    return plain(scd2(once, change, *args).select(*_SCD2_COLS))


@query(
    "asof_status",
    """WITH versions AS (
         SELECT user_id, event_id AS v, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until
         FROM events WHERE event_type IN ('signup', 'error'))
       SELECT e.event_id, v.v AS version_id FROM (SELECT * FROM events WHERE event_type = 'purchase') e
       LEFT JOIN versions v ON v.user_id = e.user_id AND e.ts >= v.ts AND (v.until IS NULL OR e.ts < v.until)""",
)
def asof_status(spark, sf_dir):
    e = gold(spark, sf_dir).raw.table("events")
    status = e.filter("event_type in ('signup', 'error')").selectExpr("user_id", "event_id", "event_type as kind", "ts")
    versions = chain_versions(status, ["user_id"], ["event_id"], "ts")
    purchases = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    got = asof_join(purchases, versions, "user_id", "ts", {"version_id": "event_id"})
    return got.select("event_id", "version_id")


@query(
    "delete_by_predicate",
    sql("headers_std", body="""SELECT order_id, customer_id FROM headers_std
        WHERE NOT coalesce(total_amount <= 0 OR customer_id >= 9000000, false)"""),
)
def delete_by_predicate(spark, sf_dir):
    h = gold(spark, sf_dir).silver.standardised("oe_order_headers_all")
    return delete_where(h, "total_amount <= 0 or customer_id >= 9000000").select("order_id", "customer_id")


@query(
    "missing_keys",
    """SELECT c_custkey AS customer_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def hard_delete_keys(spark, sf_dir):
    raw = gold(spark, sf_dir).raw
    target = raw.table("customer").selectExpr("c_custkey as customer_id")
    extract = raw.table("events").selectExpr("user_id as customer_id")
    return missing_keys(target, extract, ["customer_id"])


@query(
    "fact_merge_partitions",
    """WITH t AS (SELECT o_orderkey AS line_id, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS m, o_totalprice AS v
                  FROM orders WHERE o_orderstatus <> 'P'),
            s AS (SELECT o_orderkey AS line_id, CAST(strftime(o_orderdate + INTERVAL 1 MONTH, '%Y%m') AS INTEGER) AS m,
                  o_totalprice AS v FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1997-06-01'),
            touched AS (SELECT m FROM s UNION SELECT t.m FROM t JOIN s USING (line_id))
       SELECT line_id, m, v FROM t WHERE m IN (SELECT m FROM touched) AND line_id NOT IN (SELECT line_id FROM s)
       UNION ALL SELECT line_id, m, v FROM s""",
)
def fact_merge_partitions(spark, sf_dir):
    o = gold(spark, sf_dir).raw.table("orders")
    target = o.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("line_id"), year_month("o_orderdate").alias("m"), F.col("o_totalprice").alias("v")
    )
    moved = F.add_months("o_orderdate", 1)
    source = o.filter("o_orderpriority = '1-URGENT' and o_orderdate < '1997-06-01'").select(
        F.col("o_orderkey").alias("line_id"), year_month(moved).alias("m"), F.col("o_totalprice").alias("v")
    )
    return merge_fact(target, source, "line_id", "m", created=None)


@query(
    "fact_merge_null_partition",
    """WITH t AS (SELECT o_orderkey AS line_id, CASE WHEN o_orderstatus <> 'P' THEN CAST(strftime(o_orderdate, '%Y%m') AS INTEGER)
                  END AS m, o_totalprice AS v FROM orders),
            s AS (SELECT o_orderkey AS line_id, NULL::INTEGER AS m, o_totalprice + 1 AS v FROM orders
                  WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '1997-06-01'),
            touched AS (SELECT m FROM s UNION SELECT t.m FROM t JOIN s USING (line_id))
       SELECT t.line_id, t.m, t.v FROM t JOIN touched ON t.m IS NOT DISTINCT FROM touched.m
       WHERE t.line_id NOT IN (SELECT line_id FROM s) UNION ALL SELECT line_id, m, v FROM s""",
)
def fact_merge_null_partition(spark, sf_dir):
    # rows lose their date, so the partition without one is rewritten beside those they leave
    o = gold(spark, sf_dir).raw.table("orders")
    month = F.when(F.col("o_orderstatus") != "P", year_month("o_orderdate"))
    target = o.select(F.col("o_orderkey").alias("line_id"), month.alias("m"), F.col("o_totalprice").alias("v"))
    source = o.filter("o_orderpriority = '1-URGENT' and o_orderdate < '1997-06-01'").select(
        F.col("o_orderkey").alias("line_id"), F.lit(None).cast("int").alias("m"), (F.col("o_totalprice") + 1).alias("v")
    )
    return merge_fact(target, source, "line_id", "m", created=None)


@query(
    "scd1_missing_columns",
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_name END AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT c_custkey + 100000000, 'new', NULL FROM customer WHERE c_custkey % 8 = 0""",
)
def scd1_missing_columns(spark, sf_dir):
    # the batch brings no balances: known customers keep theirs
    c = gold(spark, sf_dir).raw.table("customer")
    target = c.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    known = c.filter("c_custkey % 4 = 0").select(F.col("c_custkey").alias("k"))
    fresh = c.filter("c_custkey % 8 = 0").select((F.col("c_custkey") + 100_000_000).alias("k"))
    return scd1(target, known.unionByName(fresh).withColumn("name", F.lit("new")), ["k"]).select("k", "name", "balance")


def _asof_overlapping(spark, sf_dir, bound):
    """Versions of very different lengths that overlap and nest."""
    e = gold(spark, sf_dir).raw.table("events")
    until = F.when(F.col("event_id") % 5 != 0, F.expr("ts + make_dt_interval(event_id % 9, event_id % 7)"))
    versions = e.filter("event_type in ('signup', 'error')").select("user_id", "event_id", F.col("ts").alias("_valid_from"), until.alias("_valid_to"))
    purchases = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return asof_join(purchases, versions, "user_id", "ts", {"version_id": "event_id"}, versions_per_key=bound).select("event_id", "version_id")


_OVERLAPPING = """
    WITH versions AS (SELECT user_id, event_id AS v, ts, CASE WHEN event_id % 5 <> 0
           THEN ts + to_days(CAST(event_id % 9 AS INTEGER)) + to_hours(event_id % 7) END AS until
         FROM events WHERE event_type IN ('signup', 'error')),
       last AS (SELECT e.event_id, arg_max(struct_pack(v := v.v, until := v.until), v.ts) AS x
         FROM (SELECT * FROM events WHERE event_type = 'purchase') e JOIN versions v ON v.user_id = e.user_id AND e.ts >= v.ts
         GROUP BY 1)
    SELECT e.event_id, CASE WHEN x.until IS NULL OR e.ts < x.until THEN x.v END AS version_id
    FROM (SELECT * FROM events WHERE event_type = 'purchase') e LEFT JOIN last USING (event_id)"""


@query("asof_overlapping_measured", _OVERLAPPING)
def asof_overlapping_measured(spark, sf_dir):
    return _asof_overlapping(spark, sf_dir, 64)


@query("asof_overlapping", _OVERLAPPING)
def asof_overlapping(spark, sf_dir):
    return _asof_overlapping(spark, sf_dir, None)


# -- data quality -------------------------------------------------------------------------------------------------

_HEADER_FAIL = """list_filter([CASE WHEN order_id IS NULL THEN 'DQ-N-005' END,
    CASE WHEN customer_id IS NULL THEN 'DQ-N-006' END,
    CASE WHEN NOT coalesce(total_amount > 0, false) THEN 'DQ-V-001' END], lambda x: x IS NOT NULL)"""


@query(
    "dq_valid_orders",
    sql("headers", body="SELECT order_id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount FROM headers"),
)
def dq_valid_orders(spark, sf_dir):
    valid, _ = q.dq_split(
        gold(spark, sf_dir).silver.standardised("oe_order_headers_all"), SILVER_DQ["oe_order_headers_all"]
    )
    return plain(valid.select("order_id", "customer_id", "total_amount"))


@query(
    "dq_quarantine_orders",
    sql("headers_std", body=f"""SELECT * FROM (SELECT order_id, array_to_string({_HEADER_FAIL}, ',') AS failed_rules
        FROM headers_std) WHERE failed_rules <> ''"""),
)
def dq_quarantine_orders(spark, sf_dir):
    _, bad = q.dq_split(
        gold(spark, sf_dir).silver.standardised("oe_order_headers_all"), SILVER_DQ["oe_order_headers_all"]
    )
    return bad.select("order_id", F.concat_ws(",", q.FAILED).alias("failed_rules"))


_EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'"


@query(
    "dq_warning_tags",
    sql("customers", body=f"""SELECT customer_id, array_to_string(list_filter([
        CASE WHEN email IS NOT NULL AND NOT regexp_matches(email, {_EMAIL}) THEN 'DQ-F-001' END,
        CASE WHEN status IS NULL THEN 'STATUS_IS_NULL' END], lambda x: x IS NOT NULL), ',') AS warnings FROM customers"""),
)
def dq_warning_tags(spark, sf_dir):
    valid, _ = q.dq_split(gold(spark, sf_dir).silver.standardised("customers"), SILVER_DQ["customers"])
    return valid.select("customer_id", F.concat_ws(",", q.WARNED).alias("warnings"))


@query(
    "dq_load_rules",
    sql("headers_std", "customers", body="""
        SELECT 'orders' AS table_name, count(*) FILTER (WHERE total_amount > 0 AND customer_id IS NOT NULL) AS written,
               count(*) FILTER (WHERE NOT (total_amount > 0 AND customer_id IS NOT NULL)) AS quarantined FROM headers_std
        UNION ALL SELECT 'customers', count(*), 0 FROM customers"""),
)
def dq_load_rules(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    out = None
    for label, name, rules in (
        ("orders", "oe_order_headers_all", ORDER_LOAD_RULES), ("customers", "customers", CUSTOMER_LOAD_RULES)
    ):
        checked = q.dq_check(s.standardised(name), rules)
        part = checked.agg(
            F.lit(label).alias("table_name"),
            F.count_if(F.size(q.FAILED) == 0).alias("written"),
            F.count_if(F.size(q.FAILED) > 0).alias("quarantined"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "dq_default_keys",
    sql("interactions_std", body="""SELECT coalesce(interaction_id IS NULL, false)::INTEGER AS failed, count(*) AS n
        FROM interactions_std GROUP BY 1"""),
)
def dq_default_keys(spark, sf_dir):
    i = gold(spark, sf_dir).silver.standardised("interactions")
    checked = q.dq_check(i, q.default_key_rules(["interaction_id"]))
    return checked.groupBy((F.size(q.FAILED) > 0).cast("int").alias("failed")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "dq_dead_letters",
    sql("surveys_std", body="""
        SELECT survey_id, rule_id, 'RANGE_CHECK' AS rule_type, column_name, 'SKIP_ROW' AS severity, 0 AS is_resolved FROM (
          SELECT survey_id, 'DQ-R-001' AS rule_id, 'nps_score' AS column_name FROM surveys_std WHERE nps_score > 10
          UNION ALL SELECT survey_id, 'DQ-R-002', 'csat_score' FROM surveys_std WHERE csat_score NOT BETWEEN 1 AND 5)"""),
)
def dq_dead_letters(spark, sf_dir):
    _, bad = q.dq_split(gold(spark, sf_dir).silver.standardised("surveys"), SILVER_DQ["surveys"])
    log = q.dlq_rows(bad, SILVER_DQ["surveys"], "run-1", "surveys", datetime(2024, 2, 1))
    return plain(
        log.select(
            F.get_json_object("row_data", "$.survey_id").cast("long").alias("survey_id"), "rule_id", "rule_type",
            "column_name", "severity", "is_resolved",
        )
    )


@query(
    "dlq_warnings",
    sql("customers", body=f"""SELECT customer_id, rule_id, 'WARNING' AS severity FROM (
        SELECT customer_id, unnest(list_filter([CASE WHEN NOT regexp_matches(email, {_EMAIL}) THEN 'DQ-F-001' END,
            CASE WHEN status IS NULL THEN 'STATUS_IS_NULL' END], lambda x: x IS NOT NULL)) AS rule_id
        FROM customers WHERE customer_id IS NOT NULL AND email IS NOT NULL)"""),
)
def dlq_warnings(spark, sf_dir):
    # rows that load with a warning are logged too
    good, _ = q.dq_split(gold(spark, sf_dir).silver.standardised("customers"), SILVER_DQ["customers"])
    log = q.dlq_rows(good, SILVER_DQ["customers"], "run-1", "customers", datetime(2024, 2, 1), q.WARNED)
    return log.select(F.get_json_object("row_data", "$.customer_id").cast("long").alias("customer_id"), "rule_id", "severity")


@query(
    "dlq_gold_rejects",
    sql("lines_std", body="""SELECT line_id, unnest(list_filter([CASE WHEN NOT coalesce(line_total >= 1500, false)
        THEN 'DQ-G-F-001' END, CASE WHEN NOT coalesce(quantity > 2, false) THEN 'DQ-G-F-002' END],
        lambda x: x IS NOT NULL)) AS rule_id FROM lines_std"""),
)
def dlq_gold_rejects(spark, sf_dir):
    # the rules of the fact with stricter limits, so that there is something to reject
    limits = {"line_total": "line_total >= 1500", "quantity": "quantity > 2"}
    rules = [replace(r, valid=limits[r.column]) for r in GOLD_DQ["fact_sales"]]
    _, bad = q.dq_split(gold(spark, sf_dir).silver.standardised("oe_order_lines_all"), rules)
    log = q.dlq_rows(bad, rules, "run-1", "fact_sales", datetime(2024, 2, 1))
    return log.select(F.get_json_object("row_data", "$.line_id").cast("long").alias("line_id"), "rule_id")


_SUMMARY_SQL = {
    "customers": ("customers", [("DQ-N-001", "ERROR", "customer_id IS NULL"), ("DQ-N-002", "SKIP_ROW", "email IS NULL"),
                                ("DQ-F-001", "WARNING", f"NOT regexp_matches(email, {_EMAIL})"),
                                ("STATUS_IS_NULL", "WARNING", "status IS NULL")]),
    "oe_order_headers_all": ("headers_std", [("DQ-N-005", "SKIP_ROW", "order_id IS NULL"),
                                             ("DQ-N-006", "SKIP_ROW", "customer_id IS NULL"),
                                             ("DQ-V-001", "SKIP_ROW", "NOT coalesce(total_amount > 0, false)")]),
    "oe_order_lines_all": ("lines_std", [("DQ-N-007", "SKIP_ROW", "line_id IS NULL"),
                                         ("DQ-N-008", "SKIP_ROW", "order_id IS NULL"),
                                         ("DQ-R-003", "SKIP_ROW", "NOT quantity > 0"),
                                         ("DQ-R-004", "SKIP_ROW", "NOT unit_price_d >= 0")]),
    "mtl_system_items_b": ("items", [("DQ-N-013", "SKIP_ROW", "inventory_item_id IS NULL"),
                                     ("DQ-R-005", "SKIP_ROW", "NOT unit_cost >= 0")]),
    "marketing_campaigns": ("campaigns", [("DQ-N-016", "SKIP_ROW", "campaign_id IS NULL"),
                                          ("DQ-R-006", "SKIP_ROW", "NOT total_spend >= 0")]),
    "customer_registration_source": ("crs", [("DQ-N-003", "SKIP_ROW", "registration_source_id IS NULL"),
                                             ("DQ-N-004", "SKIP_ROW", "customer_id IS NULL")]),
    "addresses": ("addresses", [("DQ-N-009", "SKIP_ROW", "address_id IS NULL"),
                                ("DQ-N-010", "SKIP_ROW", "customer_id IS NULL")]),
    "city_tier_master": ("tiers", [("DQ-N-011", "SKIP_ROW", "city IS NULL"), ("DQ-N-012", "SKIP_ROW", "state IS NULL")]),
    "categories": ("categories", [("DQ-N-014", "SKIP_ROW", "category_id IS NULL")]),
    "brands": ("brands", [("DQ-N-015", "SKIP_ROW", "brand_id IS NULL")]),
    "incidents": ("incidents", [("DQ-N-017", "SKIP_ROW", "incident_id IS NULL"),
                                ("DQ-N-018", "SKIP_ROW", "customer_id IS NULL")]),
    "interactions": ("interactions_std", [("DQ-N-019", "SKIP_ROW", "interaction_id IS NULL"),
                                          ("DQ-N-020", "SKIP_ROW", "incident_id IS NULL")]),
    "surveys": ("surveys_std", [("DQ-N-021", "SKIP_ROW", "survey_id IS NULL"), ("DQ-N-022", "SKIP_ROW", "customer_id IS NULL"),
                                ("DQ-R-001", "SKIP_ROW", "nps_score NOT BETWEEN 0 AND 10"),
                                ("DQ-R-002", "SKIP_ROW", "csat_score NOT BETWEEN 1 AND 5")]),
}


@query(
    "dq_rule_summary",
    sql(*{cte for cte, _ in _SUMMARY_SQL.values()}, body="\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, count(*) AS total_records_checked, '{rid}' AS rule_id, '{sev}' AS severity, "
        f"count(*) FILTER (WHERE {bad}) AS failed_count FROM {cte}"
        for table, (cte, rules) in _SUMMARY_SQL.items() for rid, sev, bad in rules)),
)
def dq_rule_summary(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    out = None
    for name, rules in SILVER_DQ.items():
        part = q.dq_summary(s.standardised(name), rules, name)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "dq_referential",
    sql("headers", "customers", "crs", "lines", body="""
        SELECT 'DQ-RI-001' AS rule_id, count(*) AS failed_count FROM headers
        WHERE customer_id NOT IN (SELECT customer_id FROM customers)
        UNION ALL SELECT 'DQ-RI-002', count(*) FROM crs WHERE customer_id NOT IN (SELECT customer_id FROM customers)
        UNION ALL SELECT 'DQ-RI-003', count(*) FROM lines WHERE order_id NOT IN (SELECT order_id FROM headers)"""),
)
def dq_referential(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    out = None
    for rule_id, child, key, parent, parent_key in REFERENTIAL:
        part = q.ri_violation_count(s(child), s(parent), key, rule_id, parent_key)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "dq_orphan_orders",
    sql("headers", "customers", body="""SELECT order_id, customer_id FROM headers
        WHERE customer_id NOT IN (SELECT customer_id FROM customers)"""),
)
def dq_orphan_orders(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    return orphans(s("oe_order_headers_all"), s("customers"), "customer_id").select("order_id", "customer_id")


@query(
    "dq_lines_with_parent",
    sql("headers", "lines", body="SELECT line_id, order_id FROM lines WHERE order_id IN (SELECT order_id FROM headers)"),
)
def dq_lines_with_parent(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    return with_parent(s("oe_order_lines_all"), s("oe_order_headers_all"), "order_id").select("line_id", "order_id")


@query(
    "dq_duplicate_keys",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS row_count FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_duplicate_keys(spark, sf_dir):
    lines = gold(spark, sf_dir).raw.table("lineitem").selectExpr("l_orderkey as order_id", "l_linenumber as line_number")
    return q.uniqueness_violations(lines, ["order_id", "line_number"])


@query(
    "dq_scd_overlaps",
    """WITH v AS (SELECT user_id, event_id, ts AS f, ts + CAST(CAST(floor(value * 60) AS BIGINT) AS INTEGER) * INTERVAL 1 SECOND AS t,
                  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
       SELECT user_id, event_id AS _version, CASE WHEN f >= t THEN 'EMPTY_INTERVAL' ELSE 'OVERLAP' END AS violation
       FROM v WHERE f >= t OR t > nxt""",
)
def dq_scd_overlaps(spark, sf_dir):
    # every event as a version that lasts ``value`` minutes: some are empty, some run into the next one
    versions = gold(spark, sf_dir).raw.table("events").select(
        "user_id",
        F.col("event_id").alias("_version"),
        F.col("ts").alias("_valid_from"),
        F.timestamp_add("SECOND", F.floor(F.col("value") * 60).cast("int"), "ts").alias("_valid_to"),
    )
    return q.scd_violations(versions, ["user_id"]).select("user_id", "_version", "violation")


@query(
    "dq_load_metrics",
    sql("lines_std", "lines", body="""
        SELECT (SELECT count(*) FROM lineitem) AS records_read, (SELECT count(*) FROM lines) AS records_written,
               (SELECT count(*) FROM lines_std) - (SELECT count(*) FROM lines) AS records_quarantined,
               (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM lines_std) AS records_filtered"""),
)
def dq_load_metrics(spark, sf_dir):
    s = gold(spark, sf_dir).silver
    return q.load_metrics(s.raw.oe_order_lines_all(), s.checked("oe_order_lines_all"))


@query(
    "dq_error_share",
    sql("customers", body="""SELECT count(*) AS rows_checked, count(*) FILTER (WHERE customer_id IS NULL) AS error_rows,
        count(*) FILTER (WHERE customer_id IS NULL) AS null_key_rows,
        CAST(count(*) FILTER (WHERE customer_id IS NULL) AS DOUBLE) / count(*) AS error_share FROM customers"""),
)
def dq_error_share(spark, sf_dir):
    return q.error_share(gold(spark, sf_dir).silver.checked("customers"), SILVER_DQ["customers"], "customer_id")


@query(
    "dq_control_totals",
    sql("lines", body="""SELECT count(*) AS row_count, CAST(sum(line_id) AS BIGINT) AS key_sum,
        CAST(sum(line_total) AS DOUBLE) AS amount_sum FROM lines"""),
)
def dq_control_totals(spark, sf_dir):
    return plain(q.control_totals(gold(spark, sf_dir).silver("oe_order_lines_all"), "line_id", "line_total"))


@query(
    "dq_contract_keys",
    """SELECT CAST(0 AS BIGINT) AS null_key_rows, count(*) AS duplicate_keys FROM
       (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
)
def dq_contract_keys(spark, sf_dir):
    return key_issues(gold(spark, sf_dir).raw.table("lineitem"), ["l_orderkey", "l_linenumber"])


# -- run log ------------------------------------------------------------------------------------------------------

def _log(g):
    """Every event as one load of its user's table."""
    return g.raw.table("events").select(
        F.col("user_id").alias("table_id"),
        F.concat(F.lit("run-"), "event_id").alias("pipeline_run_id"),
        F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
        F.floor("value").cast("long").alias("records_loaded"),
        F.col("event_id").alias("sync_version"),
        (F.col("event_type") == "signup").alias("mark_initial"),
        F.lit(False).alias("full_reload"),
        F.col("ts").alias("ended_at"),
    )


@query(
    "runlog_state",
    """SELECT user_id AS table_id, arg_max(CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END, ts) AS last_status,
              arg_max('run-' || event_id, ts) AS last_run_id, arg_max(CAST(floor(value) AS BIGINT), ts) AS records_loaded,
              CAST(sum(CASE WHEN event_type <> 'error' THEN floor(value) ELSE 0 END) AS BIGINT) AS total_records_loaded,
              max(CASE WHEN event_type <> 'error' THEN event_id END) AS last_sync_version,
              max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS initial_load_completed, count(*) AS runs
       FROM events GROUP BY 1""",
)
def runlog_state(spark, sf_dir):
    return plain(table_state(_log(gold(spark, sf_dir))))


@query(
    "runlog_health",
    """SELECT user_id AS table_id,
              round(date_diff('second', max(CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END),
                    TIMESTAMP '2024-01-30') / 3600.0, 4) AS lag_hours,
              CAST(coalesce(sum(CASE WHEN event_type <> 'error' AND ts > TIMESTAMP '2024-01-29' THEN floor(value) END), 0)
                   AS BIGINT) AS rows_24h,
              round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END), 4) AS error_rate,
              CAST(max(CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END)
                   < TIMESTAMP '2024-01-29' AS INTEGER) AS lag_alert,
              CAST(coalesce(sum(CASE WHEN event_type <> 'error' AND ts > TIMESTAMP '2024-01-29' THEN floor(value) END), 0) = 0
                   AS INTEGER) AS no_data_alert
       FROM events WHERE ts <= TIMESTAMP '2024-01-30' GROUP BY 1""",
)
def runlog_health(spark, sf_dir):
    h = load_health(_log(gold(spark, sf_dir)), datetime(2024, 1, 30))
    return plain(h.withColumns({"lag_hours": r4("lag_hours"), "error_rate": r4("error_rate")}))
