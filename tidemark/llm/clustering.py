"""Centroid clustering of integer vectors, with a progressive nearest-centroid search in the Walsh-Hadamard domain.

Vectors are turned into integers, so all sums, centroids and distances are exact and don't depend on how the rows are
dealt over tasks. The transform ``H`` has ``H H' = width I``: the squared differences of all coefficients add up to
``width`` times the squared distance. Coefficients stand in dyadic order, where the first ``2^m`` describe a vector by
the sums of ``2^m`` equal blocks. The search adds them up from coarse to fine; the centroid that is best on the coarse
ones is finished at once, and whoever's sum so far is strictly larger than that is out. The rest finish all
coefficients, so ties are seen and go to the smaller number.

A round reads the vectors once; tasks send exact sums per centroid, and the driver holds the centroids alone.

Defined results: a vector that is null, has another number of components than ``width``, or holds a null or non-finite
one takes no part. Rows with a null id are clustered but start no centroid; repeated rows count each, and of rows that
share an id the lesser vector comes first. With fewer than ``k`` vectors there are fewer centroids; an empty table gives
no row; other columns are ignored. Components of any size are worked on exactly; a squared distance or sum beyond 64 bits
is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

SMALL = 1 << 24  # up to here coefficients, their differences and sums of squares stay inside 64 bits (width 64)
LIMB = 32
LARGEST = (1 << 63) - 1


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) for doubles; Python integers where 64 bits could run over later."""
    values = np.asarray(values, np.float64)
    if not values.size or np.abs(values).max() < SMALL / scale:
        return np.floor(values * scale).astype(np.int64)

    def exact(x: float) -> int:
        top, bottom = x.as_integer_ratio()
        return top * scale // bottom

    return np.array([[exact(x) for x in row] for row in values.tolist()], object).reshape(values.shape)


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, coefficients in dyadic order."""
    levels = x.shape[1].bit_length() - 1
    cube = x.reshape(len(x), *[2] * levels)
    for axis in range(1, levels + 1):
        first, second = np.split(cube, 2, axis)
        cube = np.concatenate([first + second, first - second], axis)
    return np.ascontiguousarray(cube.transpose(0, *range(levels, 0, -1)).reshape(x.shape))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each row; ties go to the smaller number."""
    n, width = x.shape
    tx, tc = transform(x), transform(centroids)
    sums = (tx[:, :1] - tc[:, 0][None, :]) ** 2
    guess = sums.argmin(1)
    bound = ((tx - tc[guess]) ** 2).sum(1)  # the whole sum of the one that is best so far
    alive = sums <= bound[:, None]
    start = 1
    while start < width:
        for j in range(len(centroids)):
            rows = np.flatnonzero(alive[:, j])
            sums[rows, j] += ((tx[rows, start : 2 * start] - tc[j, start : 2 * start]) ** 2).sum(1)
        alive &= sums <= bound[:, None]
        start *= 2
    worst = sums.max() + 1 if n else 0
    cluster = np.where(alive, sums, worst).argmin(1)
    return cluster, sums[np.arange(n), cluster] // width


def _search(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` with the narrowest exact numbers that hold."""
    small = all(len(m) == 0 or np.abs(m).max() < SMALL for m in (x, centroids))
    kind = np.int64 if small else object
    return nearest(x.astype(kind), centroids.astype(kind))


def _vectors(batch: pa.RecordBatch, width: int, scale: int) -> np.ndarray:
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return integers(flat.reshape(-1, width), scale)


def _split(value: int) -> Iterator[tuple[int, int]]:
    """A number as (place, signed limb): limbs can be added up by anybody without running over."""
    sign, rest, place = (-1 if value < 0 else 1), abs(value), 0
    while rest:
        yield place, sign * (rest & (1 << LIMB) - 1)
        rest >>= LIMB
        place += 1


def usable(vectors: DataFrame, id_col: str, vector_col: str, width: int) -> DataFrame:
    """(vec_id, v): the vectors that take part, as doubles."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter((F.size("v") == width) & F.coalesce(finite, F.lit(False)))


def first_centroids(rows: DataFrame, k: int, seed: int, scale: int) -> np.ndarray:
    """The vectors whose seeded digest is smallest, in its order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = rows.filter("vec_id IS NOT NULL").withColumn("_h", order).orderBy("_h", "v").limit(k).select("v").collect()
    return integers(np.array([r["v"] for r in found]), scale) if found else np.empty((0, 0), np.int64)


def cluster_sums(rows: DataFrame, centroids: np.ndarray, scale: int) -> tuple[dict[int, int], dict[tuple[int, int], int]]:
    """({cluster: number of vectors}, {(cluster, component): sum}) under the nearest centroids."""
    width = centroids.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, object)
        for batch in batches:
            x = _vectors(batch, width, scale)
            cluster, _ = _search(x, centroids)
            counts += np.bincount(cluster, minlength=len(centroids))
            for j in np.unique(cluster):
                sums[j] += x[cluster == j].sum(0).astype(object)
        out = [(j, -1, 0, int(counts[j])) for j in np.flatnonzero(counts)]
        out += [(j, i, p, part) for j in np.flatnonzero(counts) for i in range(width) for p, part in _split(int(sums[j, i]))]
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        arrays = [pa.array([int(x) for x in c], t) for c, t in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "component", "place", "part"])

    parts = rows.mapInArrow(run, "cluster int, component int, place int, part long")
    total = parts.groupBy("cluster", "component", "place").agg(F.sum("part").alias("part"))
    counts: dict[int, int] = {}
    sums: dict[tuple[int, int], int] = {}
    for r in total.collect():  # a few numbers for each centroid and component
        if r["component"] < 0:
            counts[r["cluster"]] = r["part"]
        else:
            key = r["cluster"], r["component"]
            sums[key] = sums.get(key, 0) + (r["part"] << LIMB * r["place"])
    return counts, sums


def assign(rows: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """(vec_id, cluster, distance) of each vector; distance is squared, null beyond 64 bits."""
    width = centroids.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, distance = _search(_vectors(batch, width, scale), centroids)
            fits = [d if d <= LARGEST else None for d in distance.tolist()]
            arrays = [batch.column(0), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def fit(rows: DataFrame, k: int, rounds: int, seed: int, scale: int) -> np.ndarray:
    """The centroids after so many rounds; one without vectors stays where it is."""
    centroids = first_centroids(rows, k, seed, scale)
    for _ in range(rounds if len(centroids) else 0):
        counts, sums = cluster_sums(rows, centroids, scale)
        moved = centroids.astype(object)
        for j, n in counts.items():
            moved[j] = [sums.get((j, i), 0) // n for i in range(moved.shape[1])]
        centroids = moved
    return centroids


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 8,
    rounds: int = 10,
    width: int = 64,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid) of each usable vector.

    ``width`` is a power of two up to 64. ``vectors`` is read ``rounds + 2`` times, so it should be a stored table.
    """
    if not 1 <= width <= 64 or width & (width - 1):
        raise ValueError("width must be a power of two up to 64")
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, width)
    centroids = fit(rows, k, rounds, seed, scale)
    if not len(centroids):
        centroids = np.zeros((0, width), np.int64)
        placed = rows.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        placed = durable(assign(rows, centroids, scale), "assigned")
    # a cluster with a distance that doesn't fit has no inertia
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    totals = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(whole.alias("s")).collect()}  # k rows

    def fitting(values: list) -> int | None:
        total = None if None in values else sum(map(int, values))
        return total if total is not None and total <= LARGEST else None

    every = fitting(list(totals.values()))
    facts = []
    for j, c in enumerate(centroids.tolist()):
        text = ",".join(map(str, c))
        facts.append((j, fitting([totals[j]]) if j in totals else 0, every, hashlib.sha256(text.encode()).hexdigest(), text))
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid string"
    return placed.join(F.broadcast(spark.createDataFrame(facts, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid"
    )
