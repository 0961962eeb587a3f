"""Levels of deep graphs, the interleaved layout, reconciliation by digests, distinct counts over entities."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.digests import differing_leaves, digest_tree, reconcile_ranges
from tidemark.operators.lineage import CycleError, dependency_levels
from tidemark.plans.metrics import Measure, Model, derived, query_metrics
from tidemark.sources import sinks


def levels_by_hand(nodes, edges):
    parents = {n: {p for c, p in edges if c == n and p in nodes} for n in nodes}
    known = {}
    while len(known) < len(nodes):
        ready = [n for n in nodes if n not in known and all(p in known for p in parents[n])]
        for n in ready:
            known[n] = 1 + max((known[p] for p in parents[n]), default=-1)
    return known


def levels(spark, nodes, edges, peel):
    n = spark.createDataFrame([(x,) for x in nodes], "node long")
    e = spark.createDataFrame(edges, "node long, depends_on long")
    return {r.node: r.level for r in dependency_levels(n, e, peel=peel).collect()}


@pytest.mark.parametrize("seed,peel", [(1, 1), (2, 2), (3, 16)])
def test_levels_of_random_graphs(spark, seed, peel):
    # chains, forks and meetings; a small number of rounds before chains are taken out
    r = random.Random(seed)
    nodes = list(range(60))
    edges = [(n, n - 1) for n in range(1, 60) if n % 13] + [(n, r.randrange(n)) for n in r.sample(range(1, 60), 12)]
    edges += edges[:3] + [(5, 999)]
    assert levels(spark, nodes, edges, peel) == levels_by_hand(set(nodes), edges)


def test_levels_of_a_long_chain_and_cycles(spark):
    n = 1500
    chain = spark.range(n).select(F.col("id").alias("node"))
    edges = chain.filter("node > 0").selectExpr("node", "node - 1 as depends_on")
    got = dependency_levels(chain, edges, peel=4)
    assert got.filter("node != level").count() == 0 and got.count() == n
    for loop in [(10, n - 1), (7, 7)]:
        with pytest.raises(CycleError):
            dependency_levels(chain, edges.union(spark.createDataFrame([loop], edges.schema)), peel=2)
    assert dependency_levels(chain.limit(0), edges).count() == 0


def share_of_files(spark, path, condition):
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count_if(F.expr(condition)).alias("n"))
    return files.agg(F.count_if(F.col("n") > 0) / F.count(F.lit(1))).first()[0]


def test_interleaved_layout_skips_on_every_column(spark, tmp_path):
    df = spark.range(40_000).selectExpr(
        "id", "hash(id) as a", "concat('k', lpad(pmod(hash(id, 1), 5000), 5, '0')) as b", "if(id % 3 = 0, null, date_add(date'2020-01-01', cast(pmod(hash(id, 2), 900) as int))) as c"
    )
    sinks.write_table(df, str(tmp_path / "z"), cluster_by=["a", "b"], files=64)
    sinks.clustered(df, ["a", "b"], 64).write.parquet(str(tmp_path / "range"))
    second = "b between 'k01000' and 'k01100'"
    assert share_of_files(spark, str(tmp_path / "range"), second) > 0.9
    assert share_of_files(spark, str(tmp_path / "z"), second) <= 0.5
    assert share_of_files(spark, str(tmp_path / "z"), "a between 1000 and 40000000") <= 0.5
    assert spark.read.parquet(str(tmp_path / "z")).exceptAll(df).count() == 0
    # a third of the rows is null, or one value: no file holds them all
    sizes = [r["count"] for r in sinks.interleaved(df.withColumn("a", F.lit(1)), ["a", "c"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 40_000 / 3
    assert sinks.interleaved(df.limit(0), ["a", "c"], 4).count() == 0


def test_reconcile_by_digests(spark):
    left = spark.range(200_000).selectExpr("id", "if(id % 5 = 0, null, id * 2) as x", "if(id % 5 = 0, id * 2, null) as y")
    right = left.filter("id != 70000").selectExpr("id", "if(id = 10, 20, x) as x", "if(id = 10, null, y) as y")  # values change places
    right = right.unionByName(spark.sql("select -5L as id, 1L as x, 1L as y union all select id, x, y from (select 99L id, 198L x, null y)"))
    got = {(r.id, r.status, r.n_left, r.n_right) for r in reconcile_ranges(left, right, "id").collect()}
    assert got == {(70000, "missing", 1, 0), (10, "changed", 1, 1), (-5, "extra", 0, 1), (99, "changed", 1, 2)}
    trees = digest_tree(left, "id"), digest_tree(right, "id")
    assert {r.leaf for r in differing_leaves(*trees).collect()} == {-1, 0, 17}
    assert reconcile_ranges(left, left.repartition(7), "id", left_tree=trees[0]).count() == 0
    text = spark.createDataFrame([("a", 1), (None, 2), ("a", 1)], "k string, v int")
    other = spark.createDataFrame([("a", 1), (None, 3), ("é", 0)], "k string, v int")
    got = {(r.k, r.status, r.n_left, r.n_right) for r in reconcile_ranges(text, other, "k").collect()}
    assert got == {("a", "changed", 2, 1), (None, "changed", 1, 1), ("é", "extra", 0, 1)}
    assert [r.status for r in reconcile_ranges(text.limit(0), other, "k").collect()] == ["extra"] * 3


def test_distinct_counts_over_entities(spark, monkeypatch):
    from tidemark.plans import metrics

    monkeypatch.setitem(metrics.METRICS, "buyers", derived("buyers", "n_buyers", "n_buyers"))
    monkeypatch.setitem(metrics.METRICS, "amount", derived("amount", "n_amount", "n_amount"))
    models = {
        "sale": Model("sale", "sale", {"shop": "shop"}, {}, (Measure("n_buyers", "count_distinct", "buyer"), Measure("n_amount", "sum", "amount"))),
        "shop": Model("shop", "shop", {"shop": "shop", "town": "town"}),
        "town": Model("town", "town", {"town": "town"}, {"size": "size"}),
    }
    tables = {
        "sale": spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 4), (3, None, 8), (4, "z", 16), (None, "q", 32)], "shop int, buyer string, amount int"),
        "shop": spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 1)], "shop int, town int"),
        "town": spark.createDataFrame([(1, "big"), (2, "big"), (3, "small"), (4, None)], "town int, size string"),
    }
    got = {r["size"]: (r.buyers, r.amount) for r in query_metrics(tables, ["buyers", "amount"], ["size"], models=models).collect()}
    assert got == {"big": (2, 7), "small": (0, 8), None: (1, 16)}
    with pytest.raises(ValueError, match="can be grouped"):
        query_metrics(tables, ["buyers"], ["colour"], models=models)
