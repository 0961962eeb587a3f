"""Approximate nearest neighbours by learned partitions.

A neighbour graph over a bounded sample is cut into balanced parts; a small classifier learns, for each vector, how its
neighbours spread over the parts. The classifier gives every row its most probable part and sends each query to the several
most probable ones, where all rows are compared exactly, in double precision.

The sample holds at most ``SAMPLE`` vectors (those with the least hash of the id); the index holds every row. Parts beyond a
block of rows are cut into blocks, and the queries of a part meet each block of it, so that neither a large part nor many
equal vectors stand in one task. No row is left out of a part.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers, and rows with a null id, take no
part; a vector is compared with those of its own length, and all lengths but the most frequent one are compared in full;
scores are right for components of any magnitude; rows of one id are one candidate, with the best of their scores; ties go
to the smaller id; fewer candidates than asked for give fewer rows; an empty table gives no row; other columns of the input
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

SAMPLE = 8192  # documented bound: vectors the graph and the classifier are fitted on
PARTS = 256
PROBE_SHARE = 0.6  # share of the parts that a query visits
NEIGHBOURS = 10
BLOCK = 4096  # candidates of one block
QUERIES = 16384  # queries of one block


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that nothing over- or underflows."""
    x = scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each row by cosine, in blocks of rows."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for start in range(0, len(x), 1024):
        near = x[start : start + 1024] @ x.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        out[start : start + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each node: grown from seeds along edges up to a size, then refined by moves that cut fewer edges."""
    n = len(graph)
    room = -(-n * 21 // (parts * 20))  # five percent above an even share
    around: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(graph.tolist()):
        for j in row:
            around[i].append(j)
            around[j].append(i)
    part = np.full(n, -1)
    sizes = np.zeros(parts, np.int64)
    order = sorted(range(n), key=lambda i: -len(around[i]))
    at = 0
    for p in range(parts):
        links: dict[int, int] = {}
        goal = -(-(n - int(sizes.sum())) // (parts - p))
        while sizes[p] < goal:
            if links:
                i = max(links, key=links.get) if len(links) < 64 else max(list(links)[:512], key=links.get)
                del links[i]
            else:
                while at < n and part[order[at]] >= 0:
                    at += 1
                i = order[at]
            if part[i] >= 0:
                continue
            part[i] = p
            sizes[p] += 1
            for j in around[i]:
                if part[j] < 0:
                    links[j] = links.get(j, 0) + 1
    for _ in range(rounds):
        moved = 0
        for i in range(n):
            votes = np.bincount(part[around[i]], minlength=parts) if around[i] else np.zeros(parts)
            best = int(votes.argmax())
            if best != part[i] and votes[best] > votes[part[i]] and sizes[best] < room:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer: probabilities of the parts for vectors of length one."""

    weights: list[np.ndarray]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        z = np.maximum(x @ a + b, 0) @ c + d
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_router(x: np.ndarray, goal: np.ndarray, hidden: int = 64, steps: int = 120, rate: float = 0.01) -> Router:
    """Cross-entropy against ``goal`` (a distribution over parts for each row), by Adam over batches in fixed order."""
    rng = np.random.default_rng(0)
    size = (x.shape[1], hidden, goal.shape[1])
    w = [
        rng.normal(0, np.sqrt(2 / size[0]), size[:2]), np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), size[1:]), np.zeros(size[2]),
    ]
    first, second = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    for step in range(1, steps + 1):
        rows = rng.choice(len(x), min(len(x), 1024), replace=False)
        xb, hb = x[rows], np.maximum(x[rows] @ w[0] + w[1], 0)
        z = hb @ w[2] + w[3]
        z = np.exp(z - z.max(1, keepdims=True))
        error = (z / z.sum(1, keepdims=True) - goal[rows]) / len(rows)
        back = error @ w[2].T * (hb > 0)
        grads = [xb.T @ back + 1e-5 * w[0], back.sum(0), hb.T @ error + 1e-5 * w[2], error.sum(0)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            w[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Router(w)


def learn_parts(sample: np.ndarray, parts: int = PARTS) -> Router:
    """Graph, balanced cut and classifier from the vectors of the sample."""
    x = unit(sample.astype(np.float64))
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(graph, parts)
    goal = np.zeros((len(x), parts))
    rows = np.repeat(np.arange(len(x)), graph.shape[1])
    np.add.at(goal, (rows, part[graph].ravel()), 1.0)
    np.add.at(goal, (np.arange(len(x)), part), 2.0)
    return fit_router(x, goal / goal.sum(1, keepdims=True))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part: no null, zero or non-finite vector."""
    big = float(np.finfo(np.float64).max)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= big)) & F.exists("v", lambda x: x != 0)
    )


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near one: exact, and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, each summed in the same order whatever stands beside it."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest of ``rows`` for each query: products first, then all within rounding of the k-th exactly."""
    if not rows["vec_id"].is_unique:  # equal rows would take the places of others
        rows = rows[~rows.assign(key=rows["v"].map(_bytes)).duplicated(["vec_id", "key"])]
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy())
    ux = unit(x)
    out = []
    for start in range(0, len(queries), 1024):
        part = queries.iloc[start : start + 1024]
        qid, q = part["vec_id"].to_numpy(), np.stack(part["v"].to_numpy())
        near = unit(q) @ ux.T
        near[qid[:, None] == ids[None, :]] = -np.inf
        if near.shape[1] > k:
            floor = -np.partition(-near, k - 1, axis=1)[:, k - 1]
            left, right = np.nonzero(near >= np.maximum(floor - 1e-9, -2)[:, None])
        else:
            left, right = np.nonzero(near > -2)
        found = pd.DataFrame({"query_id": qid[left], "vec_id": ids[right], "score": cosines(q[left], x[right])})
        found = found.groupby(["query_id", "vec_id"], as_index=False)["score"].max()
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        out.append(found.groupby("query_id").head(k))
    return pd.concat(out)


def _bytes(v) -> bytes:
    return np.asarray(v, np.float64).tobytes()


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, parts: int = PARTS, probe_share: float = PROBE_SHARE,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``vectors`` found for each row of ``queries``."""
    from pyspark.sql import Window

    spark = vectors.sparkSession
    rows, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col)
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width_of_most = most["n"] if most else 0
    sample = rows.filter(F.size("v") == width_of_most).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    schema = "query_id long, rank int, vec_id long, score double"
    if sample.empty:
        return spark.createDataFrame([], schema)
    parts = max(1, min(parts, len(sample) // 16))
    probes = int(np.ceil(parts * probe_share))
    router = learn_parts(np.stack(sample["v"].to_numpy()), parts) if parts > 1 else None
    sent = spark.sparkContext.broadcast(router)

    def routed(df: DataFrame, width: int) -> DataFrame:
        def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                lengths = batch["v"].map(len).to_numpy()
                usual = lengths == width_of_most
                for other in np.flatnonzero(~usual):  # vectors of another length are a part of their own
                    yield batch.iloc[[other]].assign(parts=[np.array([-lengths[other]])])
                batch = batch[usual]
                if len(batch):
                    chosen = np.zeros((len(batch), 1), np.int64)
                    if sent.value is not None:
                        p = sent.value.probabilities(unit(np.stack(batch["v"].to_numpy()).astype(np.float64)))
                        chosen = np.argsort(-p, axis=1, kind="stable")[:, :width]
                    yield batch.assign(parts=list(chosen))

        return df.mapInPandas(run, "vec_id long, v array<double>, parts array<long>")

    index = durable(routed(rows, 1).select("vec_id", "v", F.col("parts")[0].alias("part")), "index")
    asked = durable(routed(asked, probes).withColumn("part", F.explode("parts")).drop("parts"), "asked")
    sizes = index.groupBy("part").count().join(asked.groupBy("part").agg(F.count("*").alias("asked")), "part")
    blocks = {r["part"]: (-(-r["count"] // BLOCK), -(-r["asked"] // QUERIES)) for r in sizes.collect()}  # a row for each part
    if not blocks:
        return spark.createDataFrame([], schema)
    plan = spark.createDataFrame([(p, r, q) for p, (r, q) in blocks.items()], "part long, row_blocks long, query_blocks long")
    salt = F.xxhash64(F.col("vec_id"), F.lit(1))
    placed = index.join(F.broadcast(plan), "part").select(
        "part", F.pmod(salt, "row_blocks").alias("row_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("query_block"), "vec_id", "v",
    )
    calls = asked.join(F.broadcast(plan), "part").select(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)).alias("row_block"),
        F.pmod(salt, "query_blocks").alias("query_block"), "vec_id", "v",
    )
    keys = ["part", "row_block", "query_block"]

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return _best(a, b, k)

    found = calls.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(compare, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
