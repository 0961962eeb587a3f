"""Which stored facts a change of other tables reaches.

A fact row holds answers of lookups (customer version, campaign, location, product, incident). When a lookup table changes,
the answers of some rows that are not in the batch change as well, so the set of facts to build anew is made of

* the rows of the batch itself,
* rows whose lookup key has another answer than before (``changed_keys``),
* rows at or after the moment from which the versions of their key differ (``changed_since``). This resolves early facts
  too: they stand at the unknown member until the first version that covers them arrives.

Each comparison of two states is one grouping, without a join; the stored facts and their sources are then cut down by semi
joins on narrow columns, before any lookup runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import FAR_FUTURE

SIGN = "_sign"


def changed_keys(before: DataFrame, after: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Distinct non-null keys whose (key, values) rows differ between two states, repeats counted."""
    columns = [key, *values]
    both = before.select(*columns, F.lit(-1).alias(SIGN)).unionByName(after.select(*columns, F.lit(1).alias(SIGN)))
    differ = both.filter(F.col(key).isNotNull()).groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)
    return differ.select(key).distinct()


def changed_since(
    before: DataFrame,
    after: DataFrame,
    key: str,
    version: str,
    valid_from: str = "_valid_from",
    valid_to: str = "_valid_to",
) -> DataFrame:
    """(key, since): the earliest moment at which a point-in-time lookup of the key may answer otherwise than before.

    A version that is new or gone counts from its start; one whose end has moved counts from the earlier of the two ends.
    """
    end = F.coalesce(F.col(valid_to), F.lit(FAR_FUTURE).cast("timestamp"))
    columns = [F.col(key), F.col(version), F.col(valid_from).alias("_from"), end.alias("_to")]
    sides = [side.select(*columns, F.lit(sign).alias(SIGN)) for side, sign in ((before, -1), (after, 1))]
    both = sides[0].unionByName(sides[1]).filter(F.col(key).isNotNull() & F.col("_from").isNotNull())
    versions = both.groupBy(key, version, "_from").agg(
        F.sum(SIGN).alias(SIGN), F.min("_to").alias("_least"), F.max("_to").alias("_last")
    )
    since = F.when(F.col(SIGN) != 0, F.col("_from")).when(F.col("_least") != F.col("_last"), F.col("_least"))
    return versions.withColumn("since", since).filter("since is not null").groupBy(key).agg(F.min("since").alias("since"))


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: str, key_in_rows: str | None = None) -> DataFrame:
    """The rows whose key is in ``keys`` (null never is)."""
    found = keys.select(F.col(key).alias("_k"))
    return rows.join(found, F.col(key_in_rows or key) == F.col("_k"), "left_semi")


def rows_since(rows: DataFrame, since: DataFrame, key: str, at: str) -> DataFrame:
    """The rows of changed keys from the moment of their change on."""
    moments = since.select(F.col(key).alias("_k"), F.col("since").alias("_s"))
    return rows.join(moments, (F.col(key) == F.col("_k")) & (F.col(at) >= F.col("_s")), "left_semi")


def union_keys(parts: Sequence[DataFrame], key: str) -> DataFrame | None:
    """Distinct keys of several frames; None without any."""
    if not parts:
        return None
    return reduce(DataFrame.unionByName, [p.select(key) for p in parts]).filter(F.col(key).isNotNull()).distinct()


def sales_orders(
    headers: DataFrame,
    lines: DataFrame,
    customers: DataFrame | None = None,
    attributed: DataFrame | None = None,
    addresses: DataFrame | None = None,
    products: DataFrame | None = None,
) -> list[DataFrame]:
    """Orders (order_id) whose sales facts changed lookups reach, as one frame for each kind of change.

    ``customers`` is a result of ``changed_since`` on customer_id; the others hold changed keys: customers with another
    campaign, shipping addresses, products.
    """
    narrow = headers.select("order_id", "customer_id", "order_date", "shipping_address_id")
    found = []
    if customers is not None:
        found.append(rows_since(narrow, customers, "customer_id", "order_date").select("order_id"))
    if attributed is not None:
        found.append(rows_of_keys(narrow, attributed, "customer_id").select("order_id"))
    if addresses is not None:
        found.append(rows_of_keys(narrow, addresses, "address_id", "shipping_address_id").select("order_id"))
    if products is not None:
        sold = lines.select("order_id", "product_id")
        found.append(rows_of_keys(sold, products, "inventory_item_id", "product_id").select("order_id"))
    return found


def interactions_of(
    interactions: DataFrame, incidents: DataFrame, changed_incidents: DataFrame | None, customers: DataFrame | None
) -> list[DataFrame]:
    """Interactions (interaction_id) that changed incidents, or changed customers of their incidents, reach."""
    narrow = interactions.select("interaction_id", "incident_id", "interaction_date")
    found = []
    if changed_incidents is not None:
        found.append(rows_of_keys(narrow, changed_incidents, "incident_id").select("interaction_id"))
    if customers is not None:
        theirs = incidents.select("incident_id", "customer_id").join(customers, "customer_id")
        theirs = theirs.groupBy("incident_id").agg(F.min("since").alias("since"))
        found.append(rows_since(narrow, theirs, "incident_id", "interaction_date").select("interaction_id"))
    return found
