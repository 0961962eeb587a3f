"""Dimension builders: ``(target or None, silver inputs) -> new dimension``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import full_name
from tidemark.operators.history import scd2
from tidemark.operators.keys import MEMBERS, assign_keys, max_key, with_members
from tidemark.session import durable

AUDIT = "_created_date timestamp, _last_modified_date timestamp, _pipeline_run_id string"

# Gold dimension schemas.
SCHEMAS = {
    "dim_customer": (
        "dim_customer_key bigint, customer_id bigint, email string, phone string, full_name string, gender string, "
        "customer_type string, status string, marketing_opt_in boolean, registration_date timestamp, "
        "_valid_from timestamp, _valid_to timestamp, _is_current boolean, _version int, _hash_key string, " + AUDIT
        + ", _is_deleted boolean"
    ),
    "dim_product": (
        "dim_product_key bigint, inventory_item_id bigint, sku string, product_name string, category_name string, "
        "brand_name string, unit_cost decimal(15,2), " + AUDIT
    ),
    "dim_location": (
        "dim_location_key bigint, address_id bigint, city string, state string, postal_code string, country string, "
        "city_tier string, " + AUDIT
    ),
    "dim_campaign": (
        "dim_campaign_key bigint, campaign_id int, campaign_name string, channel string, sub_channel string, "
        "status string, start_date date, end_date date, " + AUDIT
    ),
    "dim_registration_source": (
        "dim_registration_source_key bigint, registration_source_id bigint, channel string, utm_source string, "
        "utm_medium string, utm_campaign string, device_type string, " + AUDIT
    ),
}
CUSTOMER_TRACKED = ("customer_type", "status", "marketing_opt_in")
CUSTOMER_OVERWRITE = ("email", "phone", "full_name", "gender", "registration_date")


def _stamp(df: DataFrame, run_id: str | None, now: datetime | None) -> DataFrame:
    ts = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return df.withColumns(
        {"_created_date": ts, "_last_modified_date": ts, "_pipeline_run_id": F.lit(run_id).cast("string")}
    )


def shape(df: DataFrame, name: str) -> DataFrame:
    """Project onto the gold schema; columns the source does not have become null."""
    have = {c.lower() for c in df.columns}
    out = []
    for part in SCHEMAS[name].split(", "):
        col, kind = part.split(" ", 1)
        out.append((F.col(col) if col.lower() in have else F.lit(None)).cast(kind).alias(col))
    return df.select(*out)


def empty_dim(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def _scd1_dim(
    name: str, key: str, target: DataFrame | None, source: DataFrame, run_id: str | None, now: datetime | None
) -> DataFrame:
    """Overwrite attributes of known keys, number new keys, keep the rest, add special members."""
    surrogate = f"{name}_key"
    rows = durable(_stamp(source.filter(F.col(key).isNotNull()), run_id, now), name)  # numbering reads it several times
    if target is None:
        rows = assign_keys(rows.withColumn(surrogate, F.lit(None).cast("long")), key, surrogate)
        return with_members(shape(rows, name), MEMBERS[name], surrogate)
    known = target.select(key, surrogate, F.col("_created_date").alias("_first_created"))
    rows = rows.join(known, key, "left")
    rows = rows.withColumn("_created_date", F.coalesce("_first_created", "_created_date"))
    rows = assign_keys(rows, key, surrogate, max_key(target, surrogate))
    untouched = target.join(source.select(key), key, "left_anti").select(*target.columns)
    return with_members(untouched.unionByName(shape(rows, name)), MEMBERS[name], surrogate, target)


def customer_source(silver: DataFrame) -> DataFrame:
    """Silver customers in gold form, with the documented defaults."""
    have = set(silver.columns)

    def col(name: str, kind: str):
        return F.col(name) if name in have else F.lit(None).cast(kind)

    return silver.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        col("email", "string").alias("email"),
        col("phone", "string").alias("phone"),
        full_name(col("first_name", "string"), col("last_name", "string")).alias("full_name"),
        col("gender", "string").alias("gender"),
        "customer_type",
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        F.coalesce("marketing_opt_in", F.lit(False)).alias("marketing_opt_in"),
        "registration_date",
        "last_update_date",
    )


def build_dim_customer(
    target: DataFrame | None, silver: DataFrame, run_id: str | None = None, now: datetime | None = None,
    deleted: DataFrame | None = None,
) -> DataFrame:
    """Type 2 on type, status and opt-in; type 1 on the rest; event time is ``last_update_date``.

    ``deleted`` holds the ids of all customers that are deleted by now. Their last version stays the current one, so that
    facts and customer figures keep their owner, and is flagged; a customer that comes back loses the flag.
    """
    source = _stamp(customer_source(silver), run_id, now)
    first_load = target is None
    if first_load:
        merged = scd2(None, source, ["customer_id"], CUSTOMER_TRACKED, "last_update_date")
        merged = shape(merged, "dim_customer")
        start = 0
    else:
        merged = scd2(
            target, source, ["customer_id"], CUSTOMER_TRACKED, "last_update_date", overwrite=CUSTOMER_OVERWRITE
        )
        start = max_key(target, "dim_customer_key")
    # the merge runs once; only its new versions, one for each key of the batch at most, are numbered
    merged = shape(merged, "dim_customer")
    if deleted is not None:
        marks = deleted.select("customer_id").distinct().withColumn("_gone", F.lit(True))
        marked = merged.join(marks, "customer_id", "left")
        flag = F.coalesce("_gone", F.lit(False)) & F.coalesce("_is_current", F.lit(False))
        merged = marked.withColumn("_is_deleted", flag).select(*merged.columns)
    merged = durable(merged.withColumn("_is_deleted", F.coalesce("_is_deleted", F.lit(False))), "dim_customer")
    is_new = F.col("dim_customer_key").isNull()
    fresh = assign_keys(merged.filter(is_new), "customer_id", "dim_customer_key", start)
    keyed = merged.filter(~is_new).unionByName(fresh)
    return with_members(keyed, MEMBERS["dim_customer"], "dim_customer_key", target)


def product_source(items: DataFrame, categories: DataFrame, brands: DataFrame) -> DataFrame:
    return items.join(categories.select("category_id", "category_name"), "category_id", "left").join(
        brands.select("brand_id", "brand_name"), "brand_id", "left"
    )


def location_source(addresses: DataFrame, city_tiers: DataFrame) -> DataFrame:
    return addresses.join(city_tiers.select("city", "state", "tier"), ["city", "state"], "left").withColumn(
        "city_tier", F.coalesce("tier", F.lit("UNKNOWN"))
    )


def build_dim_product(
    target: DataFrame | None, items: DataFrame, categories: DataFrame, brands: DataFrame,
    run_id: str | None = None, now: datetime | None = None,
) -> DataFrame:
    return _scd1_dim("dim_product", "inventory_item_id", target, product_source(items, categories, brands), run_id, now)


def build_dim_location(
    target: DataFrame | None, addresses: DataFrame, city_tiers: DataFrame,
    run_id: str | None = None, now: datetime | None = None,
) -> DataFrame:
    return _scd1_dim("dim_location", "address_id", target, location_source(addresses, city_tiers), run_id, now)


def build_dim_campaign(
    target: DataFrame | None, campaigns: DataFrame, run_id: str | None = None, now: datetime | None = None
) -> DataFrame:
    return _scd1_dim("dim_campaign", "campaign_id", target, campaigns, run_id, now)


def build_dim_registration_source(
    target: DataFrame | None, crs: DataFrame, run_id: str | None = None, now: datetime | None = None
) -> DataFrame:
    return _scd1_dim("dim_registration_source", "registration_source_id", target, crs, run_id, now)
