"""N-gram Jaccard join in the metric space of shingle sets.

Two texts link when their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100. Distance is one
minus similarity, which is a metric:

1. Equal sets become one point. Points that can link share a shingle among the first ``n - ceil(t * n) + 1`` of their own
   in one global order (any order is right; rare shingles come first, so common passages fall behind). Each such shingle
   names a cell; the least point of a cell is its **pivot**.
2. The members of all cells with one pivot are that pivot's **region**; regions overlap, since a boundary document stands in
   every region whose pivot it met. Each point has a signature of parity bits, and two sets differ in at least as many
   shingles as their signatures in bits, which bounds their distance from below. Members that the bound lets link to their
   pivot get their exact distance to it. All within the radius of a pivot link to it, and so to each other's component,
   without a look at any pair of them: a region of copies of one text is done here, in linear work.
3. What is left are pairs with a member that didn't link. By the **triangle inequality** such a member can link to one that
   did only if it is within two radii of the pivot; large regions are cut into blocks by that and by the size of the sets,
   and only blocks that may hold links meet. Signatures tell which members can link to another one at all.
4. These are **joined exactly** by counting common shingles, in blocks by their distance to the pivot that meet inside the
   window of one radius, and only where they don't share a component yet.

Any linked pair shares a cell, hence a region, and is met in step 2 or 4: no link between different components is lost.

The order of step 1 comes from a table of counters of fixed size that has counted every shingle of every text; only the
order depends on it, never the result. Defined results: null, empty or blank texts have an empty set, link with nothing
and are their own component; equal texts, repeated rows included, share one; a null id gets a null component; an empty
table gives no row; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bitmap, shingles
from tidemark.llm.graph import components
from tidemark.session import drop_scratch, durable, files_for, in_files, scratch_mark

COUNTERS = 1 << 24
CHUNK = 1 << 18
BINS = 20  # blocks hold one twentieth of the distance scale
BLOCK = 100_000  # shingles or cells in a block
CELLS = 1 << 22  # entries of the largest matrix built at once
CHUNK_CELLS = 1 << 20  # cells whose keys a task sorts at once, and about those of one bucket
WIDE = 64  # narrow rows that two sets or signatures weigh
KEY_BITS = 40  # of a cell's upper bits, where shared cells are looked for


def _places(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(COUNTERS - 1)).astype(np.int64)


def rarity(docs: DataFrame, k: int) -> np.ndarray:
    """A class of frequency for each of ``COUNTERS`` hash places, over all texts.

    A task marks the places it has seen with one bit each; the class grows with the number of tasks that did (about four
    times its log2). So a shingle in many documents stands behind one in few, at any size of the corpus.
    """

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(COUNTERS, bool)
        for batch in batches:
            for _, part in shingles.slices(shingles.encoded(batch["text"])):
                seen[_places(shingles.shingle_hashes(part, k)[0])] = True
        for i in np.flatnonzero(seen.reshape(-1, CHUNK).any(1)):
            yield pd.DataFrame({"chunk": [i], "n": [np.packbits(seen[i * CHUNK : (i + 1) * CHUNK]).tobytes()]})

    def add(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, n in zip(batch["chunk"], batch["n"]):
                sums[i] = sums.get(i, 0) + np.unpackbits(np.frombuffer(n, np.uint8)).astype(np.int32)
        for i, n in sums.items():
            yield pd.DataFrame({"chunk": [i], "n": [np.round(4 * np.log2(np.maximum(n, 1))).astype(np.uint8).tobytes()]})

    schema = "chunk int, n binary"
    chunks = docs.select("text").mapInPandas(count, schema).repartition(COUNTERS // CHUNK, "chunk").coalesce(COUNTERS // CHUNK)
    rows = chunks.mapInPandas(add, schema)
    out = np.zeros(COUNTERS, np.uint8)
    for row in durable(rows, "rarity").toLocalIterator():  # COUNTERS bytes in all, whatever the corpus
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["n"], np.uint8)
    return out


def _key(points: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    mixed = shingles.mix(points ^ np.uint64(0x5851F42D4C957F2D))
    return np.array([len(points) * 1_000_003 + int(points.sum()) & (1 << 64) - 1, mixed.sum()], np.uint64).tobytes()


def _parity(points: np.ndarray) -> bytes:
    """One bit for each of at least ``2 * n`` places (a power of two): whether an odd number of shingles falls there."""
    width = max(64, 1 << (2 * len(points) - 1).bit_length()) if len(points) else 64
    return np.packbits(np.bincount((points & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).tobytes()


def _differing(first: list[bytes], second: list[bytes] | None = None) -> np.ndarray:
    """Numbers of differing bits for all pairs of signatures; the longer one of a pair is folded to the shorter.

    Signatures whose lengths differ by more than one doubling belong to sets too different in size: infinity.
    """

    def by_length(side: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lengths = np.fromiter(map(len, side), np.int64, len(side))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield at, np.unpackbits(np.frombuffer(b"".join(side[i] for i in at), np.uint8)).reshape(len(at), -1)

    def signs(bits: np.ndarray, width: int) -> np.ndarray:
        if bits.shape[1] > width:
            bits = bits[:, :width] ^ bits[:, width:]
        return 1 - 2 * bits.astype(np.float32)

    second = first if second is None else second
    out = np.full((len(first), len(second)), np.inf)
    others = list(by_length(second))
    for rows, left in by_length(first):
        for columns, right in others:
            width = min(left.shape[1], right.shape[1])
            if max(left.shape[1], right.shape[1]) <= 2 * width:
                out[np.ix_(rows, columns)] = (width - signs(left, width) @ signs(right, width).T) / 2
    return out


def shingle_points(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, point) of each text."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, keys = [], []
            for points in shingles.set_rows(shingles.encoded(batch["text"]), k):
                sizes.append(len(points))
                keys.append(_key(points) if len(points) else None)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_shingles": sizes, "point": keys})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_shingles long, point binary")


def representatives(points: DataFrame) -> DataFrame:
    """(point, doc_id, n, rows): the least document of each point, and how many equal rows it has."""
    known = points.filter("point IS NOT NULL AND doc_id IS NOT NULL")
    counted = known.groupBy("point", "doc_id").agg(F.first("n_shingles").alias("n"), F.count("*").alias("rows"))
    least = counted.groupBy("point").agg(F.min(F.struct("doc_id", "n", "rows")).alias("r"))
    return least.select("point", "r.doc_id", "r.n", "r.rows")


def _of_points(docs: DataFrame, wanted: DataFrame, k: int, describe, schema: str) -> DataFrame:
    """(point, doc_id, ...) with ``describe(points)`` of the wanted points (point, doc_id, rows), from their texts.

    Texts are read once more and not shuffled: a bit map of fixed size over the wanted ids lets a task skip the others. A
    task gives each document's point once, so rows that are repeated many times don't meet in one place. What the map let
    through, and a point of rows in several tasks, is still there; ``_once`` removes both.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bitmap.build(wanted, "doc_id"))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple] = set()
        for batch in batches:
            held = bitmap.holds(sent.value, batch["place"].to_numpy(np.int64))
            ids, texts = batch["doc_id"][held].tolist(), shingles.encoded(batch["text"][held])
            for start, part in shingles.slices(texts):
                rows = []
                for doc_id, points in zip(ids[start:], shingles.set_rows(part, k)):
                    key = _key(points) if len(points) else None
                    if key is not None and (doc_id, key) not in seen:
                        seen.add((doc_id, key))
                        rows.append((key, doc_id, *describe(points)))
                if rows:
                    yield pd.DataFrame(rows, columns=["point", "doc_id", *names])

    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", bitmap.place("doc_id").alias("place"), "text")
    return rows.mapInPandas(run, f"point binary, doc_id long, {schema}")


def _ends(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(point, pivots, is_pivot, doc_id, rows) of all points of ``pairs`` (pivot, point).

    A point has no more pivots than cells, so the array is bounded by the point's own text.
    """
    both = pairs.select("point", "pivot").unionByName(pairs.select(F.col("pivot").alias("point"), F.lit(None).cast("binary").alias("pivot")))
    ends = both.groupBy("point").agg(F.collect_list("pivot").alias("pivots"), F.max(F.col("pivot").isNull()).alias("is_pivot"))
    return ends.join(reps.drop("n"), "point")


def _facing(held: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Each member of ``held`` (point, pivots, is_pivot, ...) beside ``columns`` of its pivot under their new names.

    What is wide moves by its pivot only, once as a member's and once as a pivot's.
    """
    members = held.withColumn("pivot", F.explode("pivots")).drop("pivots", "is_pivot")
    pivots = held.filter("is_pivot").select(F.col("point").alias("pivot"), *(F.col(c).alias(new) for c, new in columns.items()))
    return members.join(pivots, "pivot")


def _once(found: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """One row for each wanted point (point, doc_id, rows, ...) of a result of ``_of_points``."""
    found = durable(found.join(wanted, ["point", "doc_id"]), name)
    once = found.filter("rows = 1").unionByName(found.filter("rows > 1").dropDuplicates(["point"]))
    return once.drop("doc_id", "rows")


def _described(docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """(point, doc_id, n, prefix, parity): the cells and the signature of each point, where a point may be repeated.

    The cells are the wide part; they are written where they are made, and no join moves them.
    """
    order = docs.sparkSession.sparkContext.broadcast(rarity(docs, k))

    def describe(points: np.ndarray) -> tuple:
        n = len(points)
        # ascending by hash already, so a stable sort by class gives one global order
        chosen = np.argsort(order.value[_places(points)], kind="stable")[: n - -(-n * percent // 100) + 1]
        return n, points[chosen].view(np.int64), _parity(points)

    return durable(_of_points(docs, reps, k, describe, "n long, prefix array<long>, parity binary"), "described")


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(point, shingles) of the wanted points (point, doc_id, rows, ...), and what else is known of them."""
    return _once(_of_points(docs, wanted, k, lambda points: (points.view(np.int64),), "shingles array<long>"), wanted, "sets")


def _meet(first: list[np.ndarray], second: list[np.ndarray] | None = None) -> np.ndarray:
    """Numbers of common values of all pairs of the two lists (or of one with itself), by products of 0/1 matrices.

    The matrices are built in pieces of bounded size.
    """
    if second is None:
        values, n = np.unique(np.concatenate(first), return_counts=True)
        common = values[n > 1]
    else:
        common = np.intersect1d(np.concatenate(first), np.concatenate(second))
    lists = [first] if second is None else [first, second]
    out = np.zeros((len(first), len(lists[-1])), np.float64)
    width = max(1, CELLS // max(map(len, lists)))
    for start in range(0, len(common), width):
        part = common[start : start + width]
        sides = []
        for sets in lists:
            matrix = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                matrix[i, at[part[at] == s]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[-1].T
    return out


def _total(rows: DataFrame, weight: Column) -> int:
    return rows.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]


def _by_group(rows: DataFrame, keys: list[str], total: int, work, schema: str) -> DataFrame:
    """``work(columns, places)`` for the places of each group of ``rows``, many small groups in one call.

    Groups are dealt into buckets by their key, as many as the whole weight asks for, so that a bucket holds little more
    than its largest group; the groups themselves are bounded blocks.
    """
    buckets = max(1, -(-total // (4 * BLOCK)))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    names = [f.split()[0] for f in schema.split(", ")]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        columns = {c: frame[c].to_numpy() for c in frame.columns}
        parts = [work(columns, places) for places in frame.groupby(keys, sort=False).indices.values()]
        merged = [np.concatenate([p[i] for p in parts if len(p[i])] or [[]]) for i in range(len(names))]
        return pd.DataFrame(dict(zip(names, merged)))

    done = rows.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandas(run, schema)
    return done.coalesce(max(buckets, files_for(rows.sparkSession, 0)))  # no Python for partitions without a bucket


def _may_link(differing: np.ndarray, sizes: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether pairs of sets that differ in at least so many shingles can be similar enough."""
    a, b = sizes[0][:, None], sizes[1][None, :]
    in_size = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    # links have (100 + percent) * common >= percent * (a + b), and common = (a + b - difference) / 2
    return in_size & ((100 + percent) * differing <= (100 - percent) * (a + b))


def _bounds(signatures: DataFrame, percent: int, pairs: int) -> DataFrame:
    """(pivot, point, n, able, close): whether the signatures let a member link to its pivot, or be within two radii.

    There are ``pairs`` rows.
    """

    @F.pandas_udf("struct<able:boolean,close:boolean>")
    def judge(n: pd.Series, parity: pd.Series, m: pd.Series, other: pd.Series) -> pd.DataFrame:
        differing = np.full(len(n), np.inf)
        for i, (p, q) in enumerate(zip(parity, other)):
            p, q = (p, q) if len(p) <= len(q) else (q, p)
            if len(q) <= 2 * len(p):
                whole = int.from_bytes(q[: len(p)], "big") ^ int.from_bytes(q[len(p) :], "big")
                differing[i] = (int.from_bytes(p, "big") ^ whole).bit_count()
        a, b = n.to_numpy(np.int64), m.to_numpy(np.int64)
        able = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        able &= (100 + percent) * differing <= (100 - percent) * (a + b)
        least = np.where(np.isinf(differing), 0, np.maximum(differing, np.abs(a - b)))
        close = 100 * least <= (100 - percent) * (a + b + least)  # a distance of 2 * least / (a + b + least)
        far = np.isinf(differing) & (100 * np.minimum(a, b) < (2 * percent - 100) * np.maximum(a, b))
        return pd.DataFrame({"able": able, "close": close & ~far})

    rows = _facing(signatures, {"n": "m", "parity": "other"})
    rows = rows.select("pivot", "point", "n", judge("n", "parity", "m", "other").alias("j"))
    return durable(in_files(rows.select("pivot", "point", "n", "j.able", "j.close"), WIDE * pairs), "bounds")


# What a member of a region is: linked to the pivot; not linked, but perhaps within two radii; farther.
LINKED, CLOSE, FAR = 0, 1, 2
SIZES = 1.2  # sets in blocks of sizes that aren't neighbours on this scale can't link at 80 percent


def _able_to_link(members: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """(pivot, point) of the members (pivot, point, n, kind) that the signatures let link to another one.

    Two linked members, or a linked and a far one, don't meet.
    """
    weight = F.col("n") / 4 + 16
    step = np.log(SIZES)
    rows = members.withColumn("weight", weight)
    n = members.count()
    heavy = rows.groupBy("pivot").agg(F.sum("weight").alias("w")).filter(F.col("w") > BLOCK)
    wide = durable(in_files(heavy.select("pivot"), n), "wide")
    rows = rows.join(wide.withColumn("wide", F.lit(True)), "pivot", "left").fillna(False, ["wide"])
    # a region of less than a block isn't cut
    rows = rows.withColumn("sort", F.when(F.col("wide"), F.col("kind")).otherwise(F.lit(-1)))
    rows = rows.withColumn("size", F.when(F.col("wide"), F.floor(F.log("n") / F.lit(float(step))).cast("int")).otherwise(F.lit(0)))
    rows = durable(in_files(rows.drop("wide"), n), "members")
    blocks = rows.groupBy("pivot", "sort", "size").agg(F.ceil(F.sum("weight") / BLOCK).cast("int").alias("salts"))
    blocks = durable(in_files(blocks, n), "blocks")
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    side = [salted.select("pivot", *(F.col(c).alias(f"{c}_{x}") for c in ("sort", "size", "salt"))) for x in "ab"]
    reach = int(np.ceil(np.log(100 / percent) / step))
    meet = (F.struct("sort_a", "size_a", "salt_a") <= F.struct("sort_b", "size_b", "salt_b")) & (
        F.abs(F.col("size_a") - F.col("size_b")) <= reach
    )
    meet &= ~((F.col("sort_a") == LINKED) & F.col("sort_b").isin(LINKED, FAR))
    pairs = side[0].join(side[1], "pivot").filter(meet)
    pairs = durable(pairs.withColumn("pair", F.xxhash64("sort_a", "size_a", "salt_a", "sort_b", "size_b", "salt_b")), "pairs")
    dealt = rows.join(blocks, ["pivot", "sort", "size"])
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("point"), F.col("salts")).cast("int"))
    alone = (F.col("sort_a") == F.col("sort_b")) & (F.col("size_a") == F.col("size_b")) & (F.col("salt_a") == F.col("salt_b"))

    def placed(x: str) -> DataFrame:
        use = pairs if x == "a" else pairs.filter(~alone)
        use = use.select("pair", "pivot", *(F.col(f"{c}_{x}").alias(c) for c in ("sort", "size", "salt")))
        return use.join(dealt, ["pivot", "sort", "size", "salt"]).select("pivot", "pair", F.lit(x).alias("side"), "point", "n", "kind", "weight")

    def able(columns: dict, places: np.ndarray) -> tuple:
        side, kind = columns["side"][places], columns["kind"]
        a, b = places[side == "a"], places[side == "b"]
        single = not len(b)
        if not len(a) or single and len(a) < 2:
            return [], []
        bits = [list(columns["parity"][a]), None if single else list(columns["parity"][b])]
        b = a if single else b
        sizes = [columns["n"][x].astype(np.int64) for x in (a, b)]
        may = _may_link(_differing(*bits), sizes, percent)
        if single:
            np.fill_diagonal(may, False)
        x, y = kind[a][:, None], kind[b][None, :]
        may &= ~((np.minimum(x, y) == LINKED) & (np.maximum(x, y) != CLOSE))
        found = np.concatenate([a[may.any(1)], b[may.any(0)]])
        return columns["pivot"][found], columns["point"][found]

    loaded = durable(placed("a").unionByName(placed("b")), "placed-members")
    total = int(_total(loaded, F.col("weight")))
    loaded = loaded.join(signatures.select("point", "parity"), "point")
    found = _by_group(loaded, ["pivot", "pair"], total, able, "pivot binary, point binary").distinct()
    return durable(in_files(found, n), "able")


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one region that neither share a component nor stand outside the window.

    ``distance`` is null where the signatures have ruled out a link to the pivot; those stand in a bin of their own.
    """
    radius = 1 - percent / 100
    mixed = members.groupBy("pivot").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    rows = members.join(mixed.select("pivot"), "pivot", "left_semi")
    rows = durable(rows.withColumn("bin", F.coalesce(F.floor(F.col("distance") * BINS).cast("int"), F.lit(-1))), "mixed")
    blocks = rows.groupBy("pivot", "bin").agg(
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("salts"), F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    blocks = durable(blocks, "blocks")
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    side = [salted.select("pivot", *(F.col(c).alias(f"{c}_{x}") for c in ("bin", "salt", "lo", "hi"))) for x in "ab"]
    reach = int(np.ceil(radius * BINS)) + 1  # whole bins, and one for rounding
    pairs = side[0].join(side[1], "pivot").filter(
        (F.struct("bin_a", "salt_a") <= F.struct("bin_b", "salt_b"))
        & ((F.col("bin_a") < 0) | (F.col("bin_b") - F.col("bin_a") <= reach))
        & ~((F.col("lo_a") == F.col("hi_a")) & (F.col("lo_b") == F.col("hi_b")) & (F.col("lo_a") == F.col("lo_b")))
    )
    pairs = durable(pairs.withColumn("pair", F.xxhash64("bin_a", "salt_a", "bin_b", "salt_b")), "block-pairs")
    dealt = rows.join(blocks.select("pivot", "bin", "salts"), ["pivot", "bin"]).withColumn(
        "salt", F.pmod(F.xxhash64("point"), F.col("salts")).cast("int")
    )
    alone = (F.col("bin_a") == F.col("bin_b")) & (F.col("salt_a") == F.col("salt_b"))

    def placed(x: str) -> DataFrame:
        use = (pairs if x == "a" else pairs.filter(~alone)).select(
            "pair", "pivot", F.col(f"bin_{x}").alias("bin"), F.col(f"salt_{x}").alias("salt")
        )
        return use.join(dealt, ["pivot", "bin", "salt"]).select("pivot", "pair", F.lit(x).alias("side"), "point", "label", "n")

    def join(columns: dict, places: np.ndarray) -> tuple:
        side = columns["side"][places]
        a, b = places[side == "a"], places[side == "b"]
        if not len(a):
            return [], []
        sets = [list(columns["shingles"][a]), list(columns["shingles"][b]) if len(b) else None]
        b = b if len(b) else a
        sizes = [columns["n"][x].astype(np.int64) for x in (a, b)]
        shared = _meet(*sets)
        close = 100 * shared >= percent * (sizes[0][:, None] + sizes[1][None, :] - shared)
        close &= columns["label"][a][:, None] != columns["label"][b][None, :]
        left, right = np.nonzero(close)
        return columns["point"][a[left]], columns["point"][b[right]]

    loaded = durable(placed("a").unionByName(placed("b")), "placed")
    total = _total(loaded, F.col("n"))
    return _by_group(loaded.join(sets, "point"), ["pivot", "pair"], total, join, "a binary, b binary")


def _shared_cells(prefixes: DataFrame, total: int) -> DataFrame:
    """The keys (``_cell_key``) of all cells that two rows of ``prefixes`` have; ``total`` is about the number of cells.

    Most cells hold one point. A task sends the keys of a chunk of cells sorted, as the gaps between them, and a key that
    comes up more often in the chunk twice: about three bytes for a cell, and a frequent cell is no load.
    """
    buckets = 1 << max(6, (total // CHUNK_CELLS).bit_length())
    width = (1 << KEY_BITS) // buckets

    def packed(cells: list[np.ndarray]) -> pd.DataFrame:
        keys, n = np.unique(np.concatenate(cells).view(np.uint64) >> np.uint64(64 - KEY_BITS), return_counts=True)
        keys = np.repeat(keys.astype(np.int64), np.minimum(n, 2))
        bounds = np.searchsorted(keys, np.arange(buckets + 1) * width)
        full = np.flatnonzero(bounds[1:] > bounds[:-1])
        gaps = [np.diff(keys[bounds[i] : bounds[i + 1]], prepend=i * width) for i in full]
        # the bytes of one place of all gaps lie together, so that those of the upper places, mostly zero, take no room
        return pd.DataFrame({"bucket": full, "gaps": [g.view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T.tobytes() for g in gaps]})

    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for prefix in batch["prefix"]:
                held.append(prefix)
                size += len(prefix)
                if size >= CHUNK_CELLS:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        keys = []
        for bucket, gaps in zip(frame["bucket"], frame["gaps"]):
            wide = np.zeros((len(gaps) // (KEY_BITS // 8), 8), np.uint8)
            wide[:, : KEY_BITS // 8] = np.frombuffer(gaps, np.uint8).reshape(KEY_BITS // 8, -1).T
            keys.append(np.cumsum(wide.view(np.int64)[:, 0]) + bucket * width)
        keys = np.sort(np.concatenate(keys))
        return pd.DataFrame({"key": np.unique(keys[1:][keys[1:] == keys[:-1]])})

    rows = prefixes.select("prefix").mapInPandas(pack, "bucket long, gaps binary")
    return durable(rows.groupBy("bucket").applyInPandas(meet, "key long").coalesce(buckets), "shared-cells")


def _cell_key(cell: Column) -> Column:
    return F.shiftrightunsigned(cell, 64 - KEY_BITS)


def _star(prefixes: DataFrame, total: int) -> DataFrame:
    """(pivot, point): the points of each cell with the least of them, once for each pair."""
    # Most cells hold one point; a bit map keeps those out of the shuffle. A map that fills up would let them through.
    keys = _shared_cells(prefixes, total)
    bits = bitmap.bits_for(keys.count())
    sent = prefixes.sparkSession.sparkContext.broadcast(bitmap.build(keys, "key", bits))
    cells = prefixes.select(
        "point", F.explode(F.transform("prefix", lambda c: F.struct(c.alias("cell"), bitmap.place(_cell_key(c), bits).alias("at")))).alias("c")
    )

    @F.pandas_udf("boolean")
    def shared(places: pd.Series) -> pd.Series:
        return pd.Series(bitmap.holds(sent.value, places.to_numpy(np.int64)))

    cells = cells.filter(shared("c.at")).select("point", "c.cell")
    pivots = cells.groupBy("cell").agg(F.min("point").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    star = cells.join(pivots.select("cell", "pivot"), "cell").filter("point <> pivot").select("pivot", "point")
    return durable(star.distinct(), "star")


def _met(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, ...]:
    """Steps 1 and 2: (points, reps, signatures of points that share a cell, bounds, sets of those that may link to a pivot,
    distances to pivots)."""
    points = durable(shingle_points(docs, k), "points")
    reps = durable(in_files(representatives(points), points.count()), "reps")
    mark = scratch_mark()
    described = _described(docs, reps, k, percent)
    star = _star(described.select("point", "prefix"), int(_total(reps, F.col("n") * (100 - percent) / 100 + 1)))
    # most points share no cell, and their signatures stay where they are
    pairs = star.count()
    ends = durable(in_files(_ends(star, reps), 2 * pairs), "ends")
    shown = described.drop("prefix").filter(bitmap.may_hold(ends, "point")("point"))
    kept = scratch_mark()
    signatures = _once(shown, ends, "signatures")
    drop_scratch(docs.sparkSession, mark, kept)  # the cells are the widest table
    bounds = _bounds(signatures, percent, pairs)
    wanted = durable(in_files(_ends(bounds.filter("able").select("pivot", "point"), reps), 2 * pairs), "wanted")
    sets = _sets_of(docs, wanted, k)
    near = _facing(sets, {"shingles": "other"})
    shared = F.size(F.array_intersect("shingles", "other"))
    total = F.size("shingles") + F.size("other") - shared
    near = near.select(
        "pivot", "point", (1 - shared / total).alias("distance"), (100 * shared >= percent * total).alias("linked")
    )
    near = durable(in_files(near, WIDE * pairs), "near")
    return points, reps, signatures.select("point", "n", "parity"), bounds, sets.select("point", "shingles"), near


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _more_sets(docs: DataFrame, sets: DataFrame, able: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """The sets of all points of ``able``; those that are there already are not made again."""
    wanted = able.select("point").distinct()
    missing = wanted.join(sets.select("point"), "point", "left_anti").join(reps.drop("n"), "point")
    missing = durable(in_files(missing, able.count()), "missing")
    return sets.join(wanted, "point", "left_semi").unionByName(_sets_of(docs, missing, k))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row; the component is named by its least doc_id."""
    mark = scratch_mark()
    narrow = _narrow(docs, id_col, text_col)
    points, reps, signatures, bounds, sets, near = _met(narrow, k, percent)
    links = near.filter("linked").select(F.col("pivot").alias("a"), F.col("point").alias("b"))
    pairs = bounds.count()
    labels = durable(in_files(components(links), 2 * pairs), "labels")

    # Regions with members that didn't link to their pivot; the pivot and the linked ones may meet the close ones of these.
    members = bounds.join(near.select("pivot", "point", "linked", "distance"), ["pivot", "point"], "left")
    kind = F.when(F.coalesce("linked", F.lit(False)), LINKED).when(F.col("close"), CLOSE).otherwise(FAR)
    members = durable(in_files(members.select("pivot", "point", "n", kind.alias("kind"), "distance"), pairs), "kinds")
    count = lambda which: F.count(F.when(F.col("kind") == which, F.lit(1)))
    regions = members.groupBy("pivot").agg(count(LINKED).alias("linked"), count(CLOSE).alias("close"), count(FAR).alias("far"))
    # the pivot itself is known not to link to the rest, so two others at least have to be there
    open_ = regions.filter("close + far > 1 OR close > 0 AND linked > 0").select("pivot", (F.col("close") > 0).alias("meets"))
    left = members.join(open_, "pivot").filter((F.col("kind") != LINKED) | F.col("meets")).drop("meets")
    left = durable(in_files(left, pairs), "left")
    able = _able_to_link(left.drop("distance"), signatures, percent)
    left = left.drop("kind").join(able, ["pivot", "point"], "left_semi")
    left = left.join(labels.withColumnRenamed("node", "point"), "point", "left").withColumn("label", F.coalesce("label", "point"))
    more = durable(_block_links(left, _more_sets(narrow, sets, able, reps, k), percent).distinct(), "block-links")
    joined = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)
    labels = durable(in_files(components(joined), labels.count() + 2 * more.count()), "labels")

    least = reps.select("point", "doc_id").join(labels.withColumnRenamed("node", "point"), "point").groupBy("label").agg(
        F.min("doc_id").alias("component_id")
    )
    grouped = labels.join(least, "label").select(F.col("node").alias("point"), "component_id")
    named = reps.select("point", "doc_id").join(grouped, "point", "left")
    named = named.select("point", F.coalesce("component_id", "doc_id").alias("component_id"))
    named = durable(in_files(named, reps.count()), "components")
    drop_scratch(docs.sparkSession, mark + 1, scratch_mark() - 1)  # the result reads the points and the components only
    return (
        points.select("doc_id", "n_shingles", "point")
        .join(named, "point", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    )


def jaccard_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links between different texts, and how many links each document has.

    The first frame has (doc_a, doc_b), doc_a < doc_b, once for each pair of linked texts, which are named by their least
    documents. The second has (doc_id, text_id, n_links) for each row of ``docs``: its text's name, and the number of other
    rows it links to, copies of its own text included; a row with a null id, or without words, has none. Here members of a
    region are compared whether or not they share a component.
    """
    narrow = _narrow(docs, id_col, text_col)
    points, reps, signatures, bounds, sets, near = _met(narrow, k, percent)
    members = durable(bounds.select("pivot", "point", "n", F.lit(CLOSE).alias("kind")), "members")
    able = _able_to_link(members, signatures, percent)
    left = members.drop("kind").join(able, ["pivot", "point"], "left_semi")
    left = left.join(near.drop("linked"), ["pivot", "point"], "left").withColumn("label", F.col("point"))
    found = _block_links(left, _more_sets(narrow, sets, able, reps, k), percent)
    found = found.unionByName(near.filter("linked").select(F.col("pivot").alias("a"), F.col("point").alias("b")))
    ids = [reps.select(F.col("point").alias(x), F.col("doc_id").alias(f"doc_{x}")) for x in "ab"]
    found = found.join(ids[0], "a").join(ids[1], "b")
    links = found.select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b")).distinct()
    links = durable(links, "links")
    rows = points.filter("doc_id IS NOT NULL AND point IS NOT NULL").groupBy("point").agg(F.count("*").alias("copies"))
    rows = durable(rows.join(reps.select("point", F.col("doc_id").alias("text_id")), "point"), "copies")
    both = links.select(F.col("doc_a").alias("text_id"), F.col("doc_b").alias("other"))
    both = both.unionByName(links.select(F.col("doc_b").alias("text_id"), F.col("doc_a").alias("other")))
    others = rows.select(F.col("text_id").alias("other"), F.col("copies").alias("n"))
    theirs = both.join(others, "other").groupBy("text_id").agg(F.sum("n").alias("n"))
    counted = rows.join(theirs, "text_id", "left")
    counted = counted.select("point", "text_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = F.col("doc_id").isNotNull()
    per_row = points.select("doc_id", "point").join(durable(counted, "counted"), "point", "left").select(
        "doc_id",
        F.when(known, F.coalesce("text_id", "doc_id")).alias("text_id"),
        F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
    return links, per_row


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but the least document of each component; of repeated rows of that document one stays.

    Rows that share an id but not the text are different documents, and rows with a null id stay as they are.
    """
    kept = durable(found.filter("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct(), "kept")
    rows = docs.filter(F.col(id_col).isNotNull()).join(kept, F.col(id_col).cast("long") == F.col("_kept"), "left_semi")
    order = Window.partitionBy(id_col, F.xxhash64(text_col)).orderBy(*(F.xxhash64(c) for c in docs.columns if c != id_col))
    one = rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")
    return one.unionByName(docs.filter(F.col(id_col).isNull()))
