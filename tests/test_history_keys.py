"""Type 2 history, surrogate keys and special members."""

import random
from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import change_hash
from tidemark.operators.history import chain_versions, late_changes, scd2, scd2_feed, shown_versions
from tidemark.operators.keys import MEMBERS, assign_keys, max_key, with_members
from tidemark.operators.quality import scd_violations, uniqueness_violations
from tidemark.plans.dims import build_dim_campaign, build_dim_customer, build_dim_product

SRC = "id long, status string, kind string, email string, at timestamp"
D = datetime


def src(spark, *rows):
    return spark.createDataFrame(list(rows), SRC)


def versions(df):
    cols = ("id", "status", "email", "_valid_from", "_valid_to", "_is_current", "_version")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: (t[0], t[6]))


def test_scd2_close_insert_ignore_and_idempotent(spark):
    first = scd2(None, src(spark, (1, "A", "x", "e1", D(2023, 1, 1)), (2, "A", None, "e2", D(2023, 1, 1))), ["id"], ["status", "kind"], "at")
    batch = src(
        spark,
        (1, "B", "x", "e9", D(2023, 2, 1)),
        (2, "A", None, "e9", D(2023, 2, 1)),
        (3, "A", "x", "e3", D(2023, 2, 1)),
    )
    once = scd2(first, batch, ["id"], ["status", "kind"], "at")
    assert versions(once) == [
        (1, "A", "e1", D(2023, 1, 1), D(2023, 2, 1), False, 1),
        (1, "B", "e9", D(2023, 2, 1), None, True, 2),
        (2, "A", "e2", D(2023, 1, 1), None, True, 1),
        (3, "A", "e3", D(2023, 2, 1), None, True, 1),
    ]
    assert versions(scd2(once, batch, ["id"], ["status", "kind"], "at")) == versions(once)
    # null transition counts as a change
    to_null = scd2(once, src(spark, (1, None, "x", "e", D(2023, 3, 1))), ["id"], ["status", "kind"], "at")
    assert to_null.filter("id = 1").count() == 3
    # a late event is ignored and reported
    late = src(spark, (1, "Z", "x", "e", D(2022, 1, 1)))
    assert versions(scd2(once, late, ["id"], ["status", "kind"], "at")) == versions(once)
    assert late_changes(once, late, ["id"], ["status", "kind"], "at").count() == 1


def test_scd2_type1_columns_overwrite_every_version(spark):
    t = scd2(None, src(spark, (1, "A", "x", "e1", D(2023, 1, 1)), (2, "A", "x", "e2", D(2023, 1, 1))), ["id"], ["status"], "at")
    t = scd2(t, src(spark, (1, "B", "x", "e3", D(2023, 2, 1))), ["id"], ["status"], "at", overwrite=["email"])
    t = scd2(t, src(spark, (1, "B", "x", "e4", D(2023, 3, 1))), ["id"], ["status"], "at", overwrite=["email"])
    assert [(v[0], v[1], v[2]) for v in versions(t)] == [(1, "A", "e4"), (1, "B", "e4"), (2, "A", "e2")]


def brute_chain(rows):
    out = {}
    for id_, status, _, _, at in sorted(rows, key=lambda r: (r[0], r[4])):
        hist = out.setdefault(id_, [])
        if hist and hist[-1][1] == status:
            continue
        if hist:
            hist[-1][3] = at
        hist.append([id_, status, at, None, len(hist) + 1])
    return sorted((tuple(v) for h in out.values() for v in h), key=lambda t: (t[0], t[4]))


def test_chain_and_feed_match_brute_force_with_a_hot_key(spark):
    rnd = random.Random(7)
    rows, seen = [], set()
    for _ in range(500):
        id_ = 0 if rnd.random() < 0.5 else rnd.randint(1, 15)
        at = D(2023, 1, 1) + timedelta(hours=rnd.randint(0, 3000))
        if (id_, at) not in seen:
            seen.add((id_, at))
            rows.append((id_, rnd.choice(["A", "B", None]), "x", "e", at))

    def shape(df):
        cols = ("id", "status", "_valid_from", "_valid_to", "_version")
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: (t[0], t[4]))

    whole = chain_versions(src(spark, *rows), ["id"], ["status"], "at")
    assert shape(whole) == brute_chain(rows)
    assert scd_violations(whole, ["id"]).count() == 0
    assert uniqueness_violations(whole, ["id"], "_is_current").count() == 0
    # the same history in three batches, in no order
    rnd.shuffle(rows)
    part = None
    for i in range(3):
        batch = rows[i * len(rows) // 3 : (i + 1) * len(rows) // 3]
        rnd.shuffle(batch)
        part = scd2_feed(part, src(spark, *batch), ["id"], ["status"], "at")
        part = spark.createDataFrame(part.collect(), part.schema)
    assert shape(shown_versions(part)) == brute_chain(rows)


def test_feed_is_independent_of_arrival(spark):
    a, b, c = ((1, s, "x", "e", D(2023, 1, d)) for s, d in (("A", 1), ("B", 2), ("A", 3)))
    def chained(*batches):
        out = None
        for batch in batches:
            out = scd2_feed(out, src(spark, *batch), ["id"], ["status"], "at")
        return [(v[1], v[3], v[4], v[5], v[6]) for v in versions(shown_versions(out))]
    want = chained([a, b, c])
    assert [v[0] for v in want] == ["A", "B", "A"]
    assert chained([a, c], [b]) == chained([c], [b], [a]) == want


def test_feed_orders_by_sequence_and_closes_on_delete(spark):
    schema = "id long, status string, op string, seq long, at timestamp"
    def rows(*x):
        return spark.createDataFrame(list(x), schema)
    def feed(target, *x):
        return scd2_feed(target, rows(*x), ["id"], ["status"], "at", ["seq"], F.col("op") == "D")
    t = feed(None, (1, "high", "U", 9, D(2023, 1, 1)))
    t = feed(t, (1, "low", "U", 2, D(2023, 1, 1)))
    assert [r.status for r in shown_versions(t).collect()] == ["high"]
    t = feed(t, (1, None, "D", 11, D(2023, 2, 1)), (1, "back", "I", 12, D(2023, 3, 1)), (None, "x", "I", 1, D(2023, 3, 1)))
    got = [(r.status, r._valid_from, r._valid_to, r._is_current, r._version) for r in shown_versions(t).orderBy("_valid_from").collect()]
    assert got == [("high", D(2023, 1, 1), D(2023, 2, 1), False, 1), ("back", D(2023, 3, 1), None, True, 2)]
    # a change before the delete arrives late
    t = feed(t, (1, "mid", "U", 10, D(2023, 1, 15)))
    assert [(r.status, r._valid_to) for r in shown_versions(t).orderBy("_valid_from").collect()] == [
        ("high", D(2023, 1, 15)), ("mid", D(2023, 2, 1)), ("back", None)
    ]


def test_chain_compares_columns_not_joined_text(spark):
    df = spark.createDataFrame([(1, "x||y", "z", D(2023, 1, 1)), (1, "x", "y||z", D(2023, 1, 2))], "id int, a string, b string, at timestamp")
    assert chain_versions(df, ["id"], ["a", "b"], "at").count() == 2


def test_scd2_without_event_time_or_key(spark):
    first = scd2(None, src(spark, (1, "A", "x", "e1", D(2023, 1, 1)), (None, "A", "x", "e", D(2023, 1, 1))), ["id"], ["status"], "at")
    assert first.count() == 1
    late = src(spark, (1, "B", "x", "e2", None), (None, "A", "x", "e", D(2023, 1, 1)))
    t = scd2(first, late, ["id"], ["status"], "at", overwrite=["email"])
    assert versions(t) == versions(first)
    assert late_changes(first, late, ["id"], ["status"], "at").count() == 1
    t = scd2(t, src(spark, (1, "B", "x", "e3", D(2023, 2, 1))), ["id"], ["status"], "at")
    assert [v[1] for v in versions(t)] == ["A", "B"]


def test_scd2_old_events_leave_type1_columns_alone(spark):
    t = scd2(None, src(spark, (1, "A", "x", "e1", D(2023, 1, 1))), ["id"], ["status"], "at")
    t = scd2(t, src(spark, (1, "B", "x", "e2", D(2023, 3, 1))), ["id"], ["status"], "at", overwrite=["email"])
    t = scd2(t, src(spark, (1, "C", "x", "old", D(2023, 2, 1))), ["id"], ["status"], "at", overwrite=["email"])
    assert {v[2] for v in versions(t)} == {"e2"}


def test_feed_splits_history_for_a_late_change(spark):
    t = scd2_feed(None, src(spark, (1, "A", "x", "e", D(2023, 1, 1)), (1, "C", "x", "e", D(2023, 3, 1))), ["id"], ["status"], "at")
    t = scd2_feed(t, src(spark, (1, "B", "x", "e", D(2023, 2, 1))), ["id"], ["status"], "at")
    assert [(v[1], v[3], v[4], v[6]) for v in versions(shown_versions(t))] == [
        ("A", D(2023, 1, 1), D(2023, 2, 1), 1), ("B", D(2023, 2, 1), D(2023, 3, 1), 2), ("C", D(2023, 3, 1), None, 3)
    ]


def test_change_hash_is_null_safe(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(change_hash("x", "y", "z").alias("h")).distinct().count() == 2
    h = spark.sql("select 'a' x, 'b' y").select(change_hash("x", "y").alias("h"), F.expr("md5('a||b')").alias("w")).first()
    assert h.h == h.w


def test_assign_keys_equals_global_row_number(spark):
    rnd = random.Random(9)
    ids = sorted({rnd.randint(-(2**45), 2**45) for _ in range(300)} | set(range(50)))
    df = spark.createDataFrame([(i, 1000 + n if n % 7 == 0 else None) for n, i in enumerate(ids)], "k long, sk long")
    want = {
        r.k: r.sk
        for r in df.withColumn("sk", F.coalesce("sk", 5 + F.sum(F.col("sk").isNull().cast("long")).over(Window.orderBy("k")))).collect()
    }
    got = {r.k: r.sk for r in assign_keys(df, "k", "sk", 5).collect()}
    assert got == want


def test_assign_keys_with_ordinal(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (5, 1), (9, 1), (9, 2), (9, 3)], "k long, o int").withColumn(
        "sk", F.lit(None).cast("long")
    )
    got = sorted((r.k, r.o, r.sk) for r in assign_keys(df, "k", "sk", 10, "o").collect())
    assert [g[2] for g in got] == [11, 12, 13, 14, 15, 16]


def fixed(df):
    """A stored table between two batches, as in a real run."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


CUSTOMER = (
    "customer_id long, email string, phone string, first_name string, last_name string, gender string, "
    "customer_type string, status string, marketing_opt_in boolean, registration_date timestamp, last_update_date timestamp"
)


def customer(spark, kind, status, at):
    return spark.createDataFrame(
        [(1001, "a@b.com", "1", "Ann", "Lee", "F", kind, status, True, D(2023, 1, 1), at)], CUSTOMER
    )


def test_dim_customer_life(spark):
    one = fixed(build_dim_customer(None, customer(spark, "Retail", "ACTIVE", D(2023, 1, 1)), "r1", D(2023, 1, 1)))
    assert {r.dim_customer_key for r in one.collect()} == {-1, 1}
    again = build_dim_customer(one, customer(spark, "Retail", "ACTIVE", D(2023, 1, 1)), "r2", D(2023, 1, 2))
    assert again.count() == 2
    two = fixed(build_dim_customer(one, customer(spark, "Wholesale", "INACTIVE", D(2023, 2, 1)), "r3", D(2023, 2, 2)))
    got = sorted((r.dim_customer_key, r.full_name, r.status, r._valid_to, r._is_current, r._version) for r in two.collect())
    assert got == [
        (-1, "UNKNOWN", "UNKNOWN", None, True, 1),
        (1, "Ann Lee", "ACTIVE", D(2023, 2, 1), False, 1),
        (2, "Ann Lee", "INACTIVE", None, True, 2),
    ]
    three = build_dim_customer(two, customer(spark, "Wholesale", "INACTIVE", D(2023, 2, 1)), "r4", D(2023, 2, 3))
    assert three.count() == 3


def test_dim_campaign_members_and_contract(spark):
    empty = spark.createDataFrame(
        [], "campaign_id int, campaign_name string, channel string, sub_channel string, status string, start_date date, end_date date"
    )
    dim = build_dim_campaign(None, empty, "r", D(2023, 1, 1))
    assert dim.columns == [
        "dim_campaign_key", "campaign_id", "campaign_name", "channel", "sub_channel", "status", "start_date",
        "end_date", "_created_date", "_last_modified_date", "_pipeline_run_id",
    ]
    assert sorted((r.dim_campaign_key, r.campaign_id, r.campaign_name) for r in dim.collect()) == [
        (-2, -2, "ORGANIC"), (-1, -1, "UNKNOWN")
    ]
    assert with_members(dim, MEMBERS["dim_campaign"], "dim_campaign_key", dim).count() == 2


def test_scd1_dimension_keeps_keys(spark):
    items = "inventory_item_id long, category_id long, brand_id long, sku string, product_name string, unit_cost decimal(15,2)"
    cats = spark.createDataFrame([(1, "Shoes")], "category_id long, category_name string")
    brands = spark.createDataFrame([(1, "Acme")], "brand_id long, brand_name string")
    first = fixed(build_dim_product(None, spark.createDataFrame([(10, 1, 1, "A", "a", None), (20, 2, 1, "B", "b", None)], items), cats, brands, "r1", D(2023, 1, 1)))
    second = build_dim_product(first, spark.createDataFrame([(5, 1, 1, "C", "c", None), (20, 1, 9, "B2", "b2", None)], items), cats, brands, "r2", D(2023, 1, 2))
    got = sorted((r.dim_product_key, r.inventory_item_id, r.sku, r.category_name, r.brand_name, r._created_date.day if r._created_date else None) for r in second.collect())
    assert got == [
        (-1, -1, "UNKNOWN", None, None, None),
        (1, 10, "A", "Shoes", "Acme", 1),
        (2, 20, "B2", "Shoes", None, 1),
        (3, 5, "C", "Shoes", "Acme", 2),
    ]
    assert second.select(max_key(second, "dim_product_key").alias("m")).first().m == 3
