"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Test items are partitioned by the size of their shingle sets, in doubling classes. All items of a class share one
signature length, ``floor((1 - threshold) * upper) + 1`` for the upper bound of the class: an item contained to at
least the threshold misses fewer shingles than that, so at least one of its smallest hashes stands in the document. The
document's side is its full set of hashes, since a sample of a long document says almost nothing about a short item (the
Jaccard similarity of 40 shingles inside 10,000 is 0.004); so recall is complete for any length. A class is only looked
up in documents large enough to contain its least item. Candidates are then checked on the shingles themselves.

Items are a stated query set and meet all documents in blocks of bounded size, one pass for each block; documents are
never shuffled. Defined results: null, empty or blank items and texts match nothing; items with fewer words than a
shingle are looked for as whole word sequences; an item with a null id is found like any other; repeated documents are
judged each, repeated items count once; an empty table gives no row; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shingles
from tidemark.session import durable

BLOCK = 1_000_000  # item shingles sent to the tasks at once
_FILTER = 20  # bits of the table that rejects most hashes
_MATCH = "array<struct<item_id:long,n_item_shingles:long,n_shared:long,containment:double>>"


@dataclass
class Block:
    """Signatures of some items: sorted hashes, with the item, size class bound and shingle length of each."""

    ids: list[int | None]
    texts: list[str]
    sizes: np.ndarray
    threshold: float
    k: int
    signatures: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by shingle length
    least: np.ndarray  # smallest document set that can contain an item of its class


def _width(text: str, k: int) -> int:
    return min(k, len(shingles.words(text)))


def _sets(texts: list[bytes], k: int, width: int) -> Iterator[np.ndarray]:
    """Distinct shingles of ``width`` words; as items of fewer than ``k`` words have them when ``width`` is less."""
    yield from shingles.set_rows(texts, width) if width == k else _narrow(texts, width)


def _narrow(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    for _, part in shingles.slices(texts):
        w, owner = shingles.word_hashes(part)
        n = max(0, len(w) - width + 1)
        whole = np.flatnonzero(owner[:n] == owner[width - 1 :][:n])
        h = shingles._chain([np.full(1, width, np.uint64), *(w[whole + i] for i in range(width))])
        h = h[: len(whole)]
        bounds = np.searchsorted(owner[whole], np.arange(len(part) + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield np.unique(h[a:b])


def build_block(items: pd.DataFrame, threshold: float, k: int) -> Block:
    """Signatures of the items (item_id, text) of one block."""
    ids, texts = [None if pd.isna(i) else int(i) for i in items["item_id"]], items["text"].tolist()
    widths = [_width(t, k) for t in texts]
    sizes, least, found = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), {}
    for width in sorted({*widths} - {0}):
        mine = [i for i, x in enumerate(widths) if x == width]
        hashes, owners = [], []
        for i, points in zip(mine, _sets(shingles.encoded(texts[i] for i in mine), k, width)):
            sizes[i] = len(points)
            upper = 1 << int(len(points)).bit_length()  # the class holds sizes from upper / 2 to upper - 1
            least[i] = np.ceil(threshold * (upper // 2) - 1e-9)
            length = int(np.floor((1 - threshold) * (upper - 1) + 1e-9)) + 1
            hashes.append(points[:length])  # ascending hashes: the first ones are the MinHash signature
            owners.append(np.full(len(hashes[-1]), i))
        h, o = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(h, kind="stable")
        table = np.zeros(1 << _FILTER, bool)
        table[(h & np.uint64((1 << _FILTER) - 1)).astype(np.int64)] = True
        found[width] = h[order], o[order], table
    return Block(ids, texts, sizes, threshold, k, found, least)


def find_items(texts: list[str | None], block: Block) -> list[list[dict]]:
    """For each text the items it contains, by item id."""
    data = shingles.encoded(texts)
    out: list[list[dict]] = [[] for _ in texts]
    kept: dict[int, set] = {}
    for width, (h, owner, table) in block.signatures.items():
        for i, points in enumerate(_sets(data, block.k, width)):
            near = points[table[(points & np.uint64((1 << _FILTER) - 1)).astype(np.int64)]]
            if not len(near):
                continue
            first, last = np.searchsorted(h, near, "left"), np.searchsorted(h, near, "right")
            hit = {int(x) for a, b in zip(first, last) for x in owner[a:b]}
            hit = sorted(x for x in hit if len(points) >= block.least[x])
            if not hit:
                continue
            w = shingles.words(texts[i])
            have = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)}
            for x in hit:
                if x not in kept:
                    kept[x] = shingles.shingle_set(block.texts[x], block.k)
                shared = len(kept[x] & have)
                if shared >= block.threshold * len(kept[x]) - 1e-9:
                    size = len(kept[x])
                    out[i].append({"item_id": block.ids[x], "n_item_shingles": size, "n_shared": shared, "containment": shared / size})
    return [sorted(x, key=lambda m: (m["item_id"] is None, m["item_id"])) for x in out]


def item_blocks(items: DataFrame, k: int, threshold: float, size: int = BLOCK) -> Iterator[tuple[int, Block]]:
    """(number of blocks, block) for blocks of about ``size`` shingles; the driver holds one block at a time."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    rows = durable(rows.withColumn("n", F.size(F.split("text", r"\s+"))), "items")
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    count = max(1, -(-total // size))
    for number in range(count if total else 0):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        part = part.select(F.col("item_id").cast("string").alias("item_id"), "text").toPandas()  # as text: ids may be null
        if len(part):
            yield count, build_block(part.sort_values(["item_id", "text"]), threshold, k)


def _matches(sent):
    @F.pandas_udf(_MATCH)
    def matches(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(find_items(batch.tolist(), sent.value))

    return matches


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = 0.8, k: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) of every item contained to at least ``threshold``."""
    parts = []
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    for count, block in item_blocks(items, k, threshold):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        found = narrow.select("doc_id", F.explode(_matches(sent)("text")).alias("m")).select("doc_id", "m.*")
        if count > 1:  # written, so that no other block has to stay in memory
            found = durable(found, "matches")
            sent.destroy()
        parts.append(found)
    if not parts:
        return narrow.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"
        )
    return reduce(DataFrame.unionByName, parts)


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.8, k: int = 5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that contain an item; all columns and other rows as they are."""
    for count, block in item_blocks(items, k, threshold):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.filter(F.size(_matches(sent)(F.col(text_col))) == 0)
        if count > 1:
            docs = durable(docs, "clean")
            sent.destroy()
    return docs
