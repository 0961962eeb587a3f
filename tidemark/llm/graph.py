"""Connected components by alternating large and small stars, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable, in_files

HOT_SHARE = 0.001  # at most 1,000 nodes can have a larger share of the links


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _look(pairs: DataFrame, total: int) -> tuple[int, DataFrame | None]:
    """How many nodes ``a`` of ``total`` pairs have a lesser neighbour ``b`` and another one; and the nodes that have very many
    neighbours, each with the least of them and itself as ``m`` (None: no such node).

    Only one row for each node and task is shuffled, and at most ``1 / HOT_SHARE`` nodes are collected.
    """
    nodes = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"), F.count_if(F.col("b") < F.col("a")).alias("up"))
    hot = F.when((F.col("n") > HOT_SHARE * total) & (F.col("n") > 64), F.struct("a", F.least("a", "m").alias("m")))
    row = nodes.agg(F.count_if((F.col("up") > 0) & (F.col("n") > 1)).alias("open"), F.collect_list(hot).alias("hot")).first()
    kinds = dict(pairs.dtypes)
    known = pairs.sparkSession.createDataFrame(row["hot"], f"a {kinds['a']}, m {kinds['b']}") if row["hot"] else None
    return row["open"], known


def _star(pairs: DataFrame, hot: DataFrame | None) -> DataFrame:
    """Each node ``a`` with its neighbours ``b`` and the least of them and itself as ``m``.

    The neighbours of a node meet in one place, but for the nodes of ``hot``, whose least one is known: theirs stay where
    they are.
    """
    least = F.least("a", F.min("b").over(Window.partitionBy("a")))
    if hot is None:
        return pairs.withColumn("m", least)
    hot = F.broadcast(hot)
    return pairs.join(hot, "a", "left_anti").withColumn("m", least).unionByName(pairs.join(hot, "a"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); the label is the least node of its component.

    Nodes of any orderable type. A node with very many neighbours is reduced by a partial aggregate, and its rows are
    not shuffled; no component is gathered. The rounds grow with the logarithm of the longest path, and end as soon as
    every node stands under the least one of its component: links that are so from the start take none. Loops give their
    node; an empty input gives no row.
    """
    loops = edges.filter(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("b").alias("label"))
    now = durable(_both(edges).filter(F.col("a") > F.col("b")).distinct(), "stars")
    while True:
        n = now.count()  # no later table has more rows
        open_, hot = _look(_both(now), 2 * n)
        if not open_:
            break
        large = _star(_both(now), hot).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(in_files(large, n), "stars")  # every edge points down
        small = _star(large, _look(large, n)[1])
        lower = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b"))
        now = durable(in_files(small.select(lower.alias("a"), F.col("m").alias("b")).distinct(), n), "stars")
    found = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label"))).unionByName(loops).groupBy(
        "node"
    ).agg(F.min("label").alias("label"))
