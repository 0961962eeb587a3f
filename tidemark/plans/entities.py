"""Silver entities: keys, history type, layout, column transforms and quality rules.

The tables below are fixed values: column names, target types and quality rules of the thirteen source entities.
A column is written ``name:kind`` where kind is a type to cast to, or

* ``trim`` / ``upper`` / ``lower``  trimmed text, optionally in one case
* ``zero``                          DECIMAL(15,2) with NULL as 0.00
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.operators.rules import apply_rules, rule

MONEY = "decimal(15,2)"


@dataclass(frozen=True)
class Entity:
    name: str
    system: str
    keys: tuple[str, ...]
    columns: str
    load: str = "WATERMARK"
    scd: int = 1
    tracked: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    derived: dict = field(default_factory=dict)


ENTITIES = {
    e.name: e
    for e in (
        Entity(
            "customers", "SRC-002", ("customer_id",),
            "customer_id:bigint email:lower phone:trim first_name:trim last_name:trim gender:upper "
            "date_of_birth:date registration_date:timestamp customer_type:upper status:upper "
            "email_verified:boolean phone_verified:boolean marketing_opt_in:boolean preferred_language:upper "
            "created_by:trim created_date:timestamp last_update_date:timestamp",
            scd=2, tracked=("status", "customer_type", "marketing_opt_in"), cluster_by=("customer_id",),
        ),
        Entity(
            "customer_registration_source", "SRC-002", ("registration_source_id",),
            "registration_source_id:bigint customer_id:bigint channel:upper campaign_id:int utm_source:lower "
            "utm_medium:lower utm_campaign:lower utm_content:lower referrer_url:trim landing_page:trim "
            "device_type:upper registration_date:timestamp created_date:timestamp",
            cluster_by=("customer_id", "campaign_id"),
        ),
        Entity(
            "oe_order_headers_all", "SRC-001", ("order_id",),
            "order_id:bigint order_number:trim customer_id:bigint order_date:timestamp order_status:upper "
            "payment_method:upper payment_status:upper subtotal_amount:money discount_amount:zero tax_amount:zero "
            "shipping_amount:zero total_amount:money currency_code:upper shipping_address_id:bigint "
            "billing_address_id:bigint promised_date:date shipped_date:timestamp delivered_date:timestamp "
            "cancellation_reason:trim order_source:upper org_id:int created_by:trim created_date:timestamp "
            "last_update_date:timestamp",
            partition_by=("_order_year_month",), cluster_by=("customer_id",),
            derived={"_order_year_month": ("ORDER_DATE", "date_format(order_date, 'yyyy-MM')")},
        ),
        Entity(
            "oe_order_lines_all", "SRC-001", ("line_id",),
            "line_id:bigint order_id:bigint product_id:bigint quantity:int unit_price:money line_total:money "
            "created_date:timestamp last_update_date:timestamp",
            partition_by=("_order_year_month",), cluster_by=("order_id", "product_id"),
        ),
        Entity(
            "addresses", "SRC-001", ("address_id",),
            "address_id:bigint customer_id:bigint address_line1:trim address_line2:trim city:upper state:upper "
            "postal_code:upper country:upper created_date:timestamp last_update_date:timestamp",
            cluster_by=("customer_id", "city", "state"),
        ),
        Entity(
            "city_tier_master", "SRC-001", ("city", "state"),
            "city:upper state:upper tier:upper created_date:timestamp",
            load="FULL", cluster_by=("city", "state"),
        ),
        Entity(
            "mtl_system_items_b", "SRC-001", ("inventory_item_id",),
            "inventory_item_id:bigint category_id:bigint brand_id:bigint sku:upper product_name:trim "
            "description:trim unit_cost:money created_date:timestamp last_update_date:timestamp",
            cluster_by=("category_id", "brand_id"),
        ),
        Entity(
            "categories", "SRC-001", ("category_id",),
            "category_id:bigint category_name:trim parent_category_id:bigint created_date:timestamp",
            load="FULL", cluster_by=("category_id",),
        ),
        Entity(
            "brands", "SRC-001", ("brand_id",),
            "brand_id:bigint brand_name:trim created_date:timestamp",
            load="FULL", cluster_by=("brand_id",),
        ),
        Entity(
            "marketing_campaigns", "SRC-003", ("campaign_id",),
            "campaign_id:int campaign_name:trim campaign_code:upper channel:upper sub_channel:upper "
            "start_date:date end_date:date total_spend:money customers_acquired:int status:upper "
            "created_date:timestamp last_update_date:timestamp",
            load="FULL", cluster_by=("campaign_id", "channel"),
        ),
        Entity(
            "incidents", "SRC-002", ("incident_id",),
            "incident_id:bigint customer_id:bigint order_id:bigint status:upper priority:upper "
            "created_date:timestamp last_update_date:timestamp",
            cluster_by=("customer_id", "order_id"),
        ),
        Entity(
            "interactions", "SRC-002", ("interaction_id",),
            "interaction_id:bigint incident_id:bigint interaction_type:upper interaction_date:timestamp notes:trim",
            cluster_by=("incident_id",),
        ),
        Entity(
            "surveys", "SRC-002", ("survey_id",),
            "survey_id:bigint customer_id:bigint order_id:bigint incident_id:bigint survey_type:upper "
            "nps_score:int csat_score:int nps_category:upper feedback_text:trim feedback_category:upper "
            "response_date:timestamp survey_sent_date:timestamp created_date:timestamp",
            cluster_by=("customer_id", "order_id"),
        ),
    )
}


def silver_rules(name: str) -> list[dict]:
    """The transform rules of one entity, in order."""
    rules = []
    for seq, spec in enumerate(ENTITIES[name].columns.split(), start=1):
        col, kind = spec.split(":", 1)
        raw = f"`{col.upper()}`"
        if kind == "trim":
            r = rule("TRANSFORM", col.upper(), col, f"trim({raw})", seq * 10)
        elif kind in ("upper", "lower"):
            r = rule("TRANSFORM", col.upper(), col, f"{kind}(trim({raw}))", seq * 10)
        elif kind == "zero":
            r = rule("TRANSFORM", col.upper(), col, f"coalesce(try_cast({raw} as {MONEY}), 0.00)", seq * 10)
        elif kind == "money":
            r = rule("CAST", col.upper(), col, MONEY, seq * 10)
        else:
            r = rule("CAST", col.upper(), col, kind, seq * 10)
        rules.append(r)
    for seq, (col, (needs, expr)) in enumerate(ENTITIES[name].derived.items(), start=1):
        rules.append(rule("TRANSFORM", needs, col, expr, 10_000 + seq))
    return rules


def standardise(name: str, bronze: DataFrame) -> DataFrame:
    """Apply the rules whose source columns the batch has, and keep metadata columns (leading underscore)."""
    have = {c.upper() for c in bronze.columns}
    rules = [r for r in silver_rules(name) if r["source_column"] in have]
    out = apply_rules(bronze, rules)
    wanted = [r["target_column"] for r in rules]
    return out.select(*wanted, *[c for c in bronze.columns if c.startswith("_") and c not in wanted])
