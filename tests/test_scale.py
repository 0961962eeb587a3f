"""What large tables move: the rows that are sorted and shuffled stay narrow."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import lineage
from tidemark.operators.lineage import dependency_levels
from tidemark.operators.merge import merge_fact
from tidemark.plans import facts
from tidemark.session import SPLIT, SPLIT_DEFAULT, tune
from tidemark.sources.fixtures import Silver
from tidemark.streaming import jobs
from tidemark.streaming.state import NULL_FOLDER, PartitionedState
from workload.model import LINES, Gold

LINE = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
)
DAY = datetime(1996, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def lines_folder(spark, tmp_path):
    rows = [
        (1, 7, 3, 1, 2.0, 10.0, 0.0, 0.0, "N", "O", DAY),
        (1, 5, 3, 1, 4.0, 20.0, 0.0, 0.0, "N", "O", DAY),  # the same key and time: the smaller part stays
        (1, None, 3, 11, 1.0, 5.0, None, 0.0, "N", "O", None),  # shares its key with the next line, and has no time
        (2, 9, 51, 1, 1.0, 3.0, 0.0, 0.0, "N", "O", DAY),
        (3, 9, 50, 2, 1.0, 3.0, 0.0, 0.0, None, "O", DAY),
    ]
    spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_order_lines_are_deduplicated_as_staged(spark, tmp_path):
    silver = Silver(spark, lines_folder(spark, tmp_path))
    lines = silver.deduped("oe_order_lines_all")
    got = {r.LINE_ID: (r.PRODUCT_ID, r.QUANTITY, float(r.UNIT_PRICE), float(r.LINE_TOTAL)) for r in lines.collect()}
    assert got == {11: (5, 4, 5.0, 20.0), 21: (9, 1, -3.0, -3.0), 32: (9, 0, 3.0, 3.0)}
    above, below = plan_of(lines).split("Window [", 1)
    assert " div " in above and " div " not in below  # amounts are derived from the rows that stay


def test_products_are_looked_up_before_the_orders_columns_join(spark):
    lines = spark.createDataFrame(
        [(11, 1, 5, 4, 20.0, 5.0), (12, 1, None, 1, 3.0, 3.0), (13, 1, 6, 1, 3.0, 3.0)],
        "line_id long, order_id long, product_id long, quantity int, line_total double, unit_price double",
    ).withColumns({c: F.col(c).cast("decimal(15,2)") for c in ("line_total", "unit_price")})
    headers = spark.createDataFrame(
        [(1, "ORD-1", 3, DAY, "BOOKED", 8, 26.0, 0.0, 0.0)],
        "order_id long, order_number string, customer_id long, order_date timestamp, order_status string, "
        "shipping_address_id long, subtotal_amount double, discount_amount double, tax_amount double",
    ).withColumns({c: F.col(c).cast("decimal(15,2)") for c in ("subtotal_amount", "discount_amount", "tax_amount")})
    dims = {
        "dim_customer": spark.createDataFrame(
            [(1, 3, datetime(1995, 1, 1), None)],
            "dim_customer_key long, customer_id long, _valid_from timestamp, _valid_to timestamp",
        ),
        "dim_campaign": spark.createDataFrame([(4, 2)], "dim_campaign_key long, campaign_id int"),
        "dim_location": spark.createDataFrame([(6, 8)], "dim_location_key long, address_id long"),
        "dim_product": spark.createDataFrame([(9, 5)], "dim_product_key long, inventory_item_id long"),
    }
    crs = spark.createDataFrame([(3, "EMAIL", 2)], "customer_id long, channel string, campaign_id int")
    fact = facts.build_fact_sales(lines, headers, dims, crs, versions_per_key=1)
    got = {r.line_id: (r.dim_product_key, r.dim_customer_key, r.dim_campaign_key, r.dim_location_key) for r in fact.collect()}
    assert got == {11: (9, 1, 4, 6), 12: (-1, 1, 4, 6), 13: (-1, 1, 4, 6)}
    joins = [line for line in plan_of(fact).splitlines() if "Join " in line]
    depth = {key: next(i for i, j in enumerate(joins) if key in j) for key in ("(order_id", "(product_id")}
    assert depth["(order_id"] < depth["(product_id"]  # the plan's top is the last join


def test_only_the_default_split_is_made_smaller(spark):
    was = spark.conf.get(SPLIT)
    try:
        spark.conf.set(SPLIT, SPLIT_DEFAULT)
        assert tune(spark).conf.get(SPLIT) == "32m"
        spark.conf.set(SPLIT, "16m")
        assert tune(spark).conf.get(SPLIT) == "16m"
    finally:
        spark.conf.set(SPLIT, was)


def levels_of(spark, nodes, edges):
    frame = None if nodes is None else spark.createDataFrame([(n,) for n in nodes], "node string")
    found = dependency_levels(frame, spark.createDataFrame(edges, "node string, depends_on string"))
    return sorted(((r.node, r.level) for r in found.collect()), key=str)


def test_levels_without_a_list_of_nodes(spark):
    edges = [("line", "order"), ("line", "part"), ("line", "part"), ("order", "customer"), ("part", "brand"), ("lost", None), (None, "part")]
    want = [("brand", 0), ("customer", 0), ("line", 2), ("lost", 0), ("order", 1), ("part", 1), (None, 0)]
    assert levels_of(spark, None, edges) == sorted(want, key=str)
    nodes = [n for n, _ in want]
    assert levels_of(spark, [*nodes, "alone", "line"], edges) == sorted([*want, ("alone", 0)], key=str)
    # a parent that is no node doesn't count
    assert levels_of(spark, ["line", "part"], edges) == [("line", 1), ("part", 0)]


def test_edges_of_nodes_without_dependents_are_followed_once(spark, monkeypatch):
    followed = []
    reach = lineage._reach

    def counted(links, frontier, counters):
        followed.append(links.count())
        return reach(links, frontier, counters)

    monkeypatch.setattr(lineage, "_reach", counted)
    edges = [(f"line{i}", "order") for i in range(20)] + [("order", "address"), ("address", "customer")]
    assert dict(levels_of(spark, None, edges))["line7"] == 3
    assert followed == [2, 2]  # the lines' edges are in no round, and no round follows the last placed node


def test_first_facts_are_computed_once_and_written_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "durable", lambda *_: pytest.fail("the first batch is written twice"))
    state = PartitionedState(spark, str(tmp_path / "fact"), "month")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, "1996-01"), (2, None), (3, "1996-02"), (4, "1996-01")], "line_id long, month string")
    jobs.refresh_fact(state, "line_id", rows.mapInArrow(counted, rows.schema), 0)
    assert seen.value == 4
    assert sorted(state.versions()) == ["1996-01", "1996-02", NULL_FOLDER]
    assert sorted((r.line_id, r.month) for r in state.read().selectExpr("line_id", "cast(month as string) as month").collect()) == [
        (1, "1996-01"), (2, None), (3, "1996-02"), (4, "1996-01"),
    ]
    empty = PartitionedState(spark, str(tmp_path / "none"), "month")
    jobs.refresh_fact(empty, "line_id", rows.limit(0), 0)
    assert empty.versions() == {} and empty.read() is None


FACT = "line_id long, month string, x int, _created_date timestamp"


@pytest.mark.parametrize("batch, gone", [
    ([(2, "1996-03", 20, DAY), (9, "1996-07", 90, DAY), (6, None, 60, DAY), (None, "1996-02", 0, DAY)], [4, 77, None]),
    ([(1, "1996-01", 10, DAY)], None),
    ([], [3, 5]),
])
def test_large_facts_are_merged_some_partitions_at_a_time(spark, tmp_path, monkeypatch, batch, gone):
    first = datetime(1995, 1, 1)
    months = ["1996-01", "1996-02", "1996-03", None, "1996-04", "1996-05"]
    old = spark.createDataFrame([(i, months[i % 6], i, first) for i in range(1, 13)], FACT)
    new = spark.createDataFrame(batch, FACT)
    deleted = None if gone is None else spark.createDataFrame([(k,) for k in gone], "line_id long")
    gone_keys = {r[0] for r in batch} | set(gone or ())
    touched = {r[1] for r in batch} | {r.month for r in old.collect() if r.line_id in gone_keys}
    changed = merge_fact(old, new, "line_id", "month", deleted=deleted)
    untouched = old.collect() if not touched else [r for r in old.collect() if r.month not in touched]
    want = sorted(map(tuple, [*changed.collect(), *untouched]), key=str)

    state, parts, write = PartitionedState(spark, str(tmp_path / "fact"), "month"), [], PartitionedState.write

    def seen(self, rows, *rest):
        def each():
            for part in [rows] if hasattr(rows, "columns") else rows:
                parts.append({r.month for r in part.select("month").distinct().collect()})
                yield part

        write(self, each(), *rest)

    jobs.refresh_fact(state, "line_id", old, 0)
    monkeypatch.setattr(session, "PART_ROWS", 4)
    monkeypatch.setattr(PartitionedState, "write", seen)
    jobs.refresh_fact(state, "line_id", new, 1, deleted)
    got = state.read().select("line_id", F.col("month").cast("string").alias("month"), "x", "_created_date")
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert len(parts) == min(3, len(touched))
    assert sum(len(p) for p in parts) == len(set().union(*parts))  # no partition is in two of them
    with pytest.raises(Exception, match="several source rows"):
        twice = spark.createDataFrame([(1, "1996-01", 1, DAY), (1, "1996-05", 2, DAY)], FACT)
        jobs.refresh_fact(state, "line_id", twice, 2)
    assert not state.committed(2)


def test_writes_keep_no_shuffles(spark, tmp_path, monkeypatch):
    seen, writer = {}, type(spark.range(1).write)
    plain = writer.parquet

    def parquet(self, path, *rest, **named):
        seen[path.rpartition("/")[2]] = spark.conf.get(session.CLEANUP, None)
        plain(self, path, *rest, **named)

    monkeypatch.setattr(writer, "parquet", parquet)
    was = spark.conf.get(session.CLEANUP, None)
    state = PartitionedState(spark, str(tmp_path / "fact"), "month")
    halves = (spark.range(40).selectExpr("id", "cast(id % 3 as string) as month").filter(f"id % 2 = {i}") for i in (0, 1))
    state.write(halves, None, 0)
    assert seen["v=0"] == "true"
    assert spark.conf.get(session.CLEANUP, None) == was
    assert sorted(r.id for r in state.read().collect()) == list(range(40)) and len(state.versions()) == 3


def test_order_slices_hold_all_orders_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "PART_ROWS", 2)
    model = Gold(spark, lines_folder(spark, tmp_path))
    headers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (None, "e")], "order_id long, x string")
    assert model.order_slices == 3
    whole = {(r.line_id, r.order_id) for r in model.silver(LINES).collect()}

    def sides(orders=None):
        found = [(h.collect(), its.collect()) for h, its in model.in_slices(headers, orders)]
        assert len(found) == 3
        for h, its in found:  # lines are with their order
            ids = {r.order_id for r in h}
            assert all(r.order_id in ids for r in its)
        return sorted(r.x for h, _ in found for r in h), sorted((r.line_id, r.order_id) for _, its in found for r in its)

    assert sides() == (["a", "b", "c", "d", "e"], sorted(whole))
    some = spark.createDataFrame([(2,), (4,), (9,)], "order_id long")
    assert sides(some) == (["b", "d"], sorted(r for r in whole if r[1] == 2))
    folder = model._folders[LINES]
    model.unstage(LINES)
    model.unstage(LINES)
    assert folder not in session._staged
    assert sides(some)[0] == ["b", "d"]  # built anew
