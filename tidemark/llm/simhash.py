"""Near duplicates by SimHash: fingerprints meet in the middle.

1. Texts become fingerprints: every shingle's hash votes on each bit, the majority of all votes sets it.
2. **Ball hashing.** Two fingerprints at distance ``radius = 2s`` or less have a word between them that is at most ``s``
   bits from both. So every fingerprint emits all variants within ``s``, the variants are shuffled, and those that meet
   are pairs. For ``radius = 2s + 1`` only the distance ``2s + 1`` itself is left. Such a pair differs in parity, and of
   its ``2s + 1`` bits at least ``s + 1`` stand in one half of the word: fingerprints of odd parity also emit the
   variants with ``s + 1`` bits flipped in one half, which meet the ``s``-variants of the even one.
3. All members of a variant within ``s`` of it link to each other, and those at ``s + 1`` to them, by the triangle
   inequality; one link from each member to the least close one keeps every component. Pairs are deduplicated and
   verified. Fingerprints are distinct, so a variant has no more members than its ball has words (1,057 for
   radius 3), whatever the number of copies.
4. A fingerprint can have a neighbour only if one of its halves has one within ``s`` bits, so half words go through the
   same test first, 33 variants each, and only fingerprints that pass emit variants of the whole word.

Defined results: null, empty and blank texts have the fingerprint zero and are linked like any other; a row with a null
id gets a fingerprint, links nobody and has a null component; equal texts and repeated rows share a component; an empty
table gives no row; other columns of the input are ignored. Long texts are hashed in slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.shingles import LOWER, SLICE, encoded
from tidemark.operators.joins import salted_lookup
from tidemark.session import drop_scratch, durable, scratch_mark

HALF = 32
HOT_SHARE = 0.005  # a value with more of the rows is spread over several tasks; at most 200 values can have as many
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _runs(data: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text in runs of bounded size; each begins with the last ``overlap`` words of the one before."""
    data = data.translate(LOWER)
    start, carried = 0, []
    while start < len(data):
        stop = len(data)
        if stop - start > SLICE and (blank := _BLANK.search(data, start + SLICE)):
            stop = blank.start()
        words = carried + data[start:stop].split()
        yield words
        carried = words[max(0, len(words) - overlap) :]
        start = stop


def _votes(words: list[bytes], k: int, seed: int) -> np.ndarray:
    """How many shingles of a run of at least ``k`` words set each bit, highest bit first."""
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_digest
    found = [digest(line[a:b], seed) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())]
    bits = np.unpackbits(np.frombuffer(b"".join(found), np.uint8)).reshape(-1, 64)
    return bits.sum(0, dtype=np.int64)


def fingerprint(data: bytes, k: int = 3, seed: int = 42) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit number."""
    votes, n, short = np.zeros(64, np.int64), 0, []
    for words in _runs(data, k - 1):
        if len(words) >= k:
            votes += _votes(words, k, seed)
            n += len(words) - k + 1
        else:
            short = words
    if not n and short:
        votes, n = _votes(short, len(short), seed), 1
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint) of each row."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [fingerprint(data, k, seed) for data in encoded(batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fingerprint": np.array(found, np.int64)})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, fingerprint long")


def _masks(places: range, flips: Iterable[int]) -> list[int]:
    """Signed 64-bit words with so many of the places set."""
    words = [sum(1 << p for p in chosen) for n in flips for chosen in combinations(places, n)]
    return [w - (1 << 64) if w >> 63 else w for w in words]


def _each(masks: list[int]) -> Column:
    return F.explode(F.array(*(F.lit(m).cast("long") for m in masks)))


def _halves(prints: DataFrame) -> DataFrame:
    """Two rows of a fingerprint, (fingerprint, half, word); the words of the two halves never meet."""
    low = F.col("fingerprint").bitwiseAND(F.lit((1 << HALF) - 1).cast("long"))
    high = F.shiftrightunsigned("fingerprint", HALF).bitwiseOR(F.lit(1 << HALF).cast("long"))
    both = F.array(F.struct(F.lit(0).alias("half"), low.alias("word")), F.struct(F.lit(1).alias("half"), high.alias("word")))
    return prints.select("fingerprint", F.explode(both).alias("_h")).select("fingerprint", "_h.half", "_h.word")


def _with_near_half(prints: DataFrame, s: int) -> DataFrame:
    """(fingerprint, half) where another fingerprint has that half within ``s`` bits."""
    rows = _halves(prints)
    words = durable(rows.groupBy("word").agg(F.count("*").alias("n")), "half-words")
    near = words.filter("n > 1").select("word")
    if s:
        others = words.select("word", _each(_masks(range(HALF), range(1, s + 1))).alias("mask"))
        # Spark sizes exploded rows as if they were not exploded: neither side of these joins may be broadcast
        others = others.select(F.col("word").bitwiseXOR(F.col("mask")).alias("word")).hint("merge")
        near = near.union(words.select("word").join(others, "word", "left_semi")).distinct()
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = [r["word"] for r in words.filter(F.col("n") > HOT_SHARE * total).select("word").collect()]
    return salted_lookup(rows, near.hint("merge"), "word", hot).select("fingerprint", "half")


def near_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b), a < b: links between fingerprints (a column ``fingerprint``) at most ``radius`` bits apart.

    Every link is a true one, and two fingerprints within the radius are always joined by a path of links; not all pairs
    of a group are listed.
    """
    if not 0 <= radius <= 7:
        raise ValueError("the variants of a ball are listed; radius must be at most 7")
    s, odd_radius = divmod(radius, 2)
    prints = durable(prints.select("fingerprint").filter("fingerprint IS NOT NULL").distinct(), "prints")
    able = durable(_with_near_half(prints, s), "able")
    close = able.select("fingerprint").distinct().select(
        "fingerprint", _each(_masks(range(2 * HALF), range(s + 1))).alias("mask"), F.lit(True).alias("close")
    )
    variants = close
    if odd_radius:
        odd = able.filter(F.bit_count("fingerprint") % 2 == 1)
        for half in (0, 1):  # if one half differs in at most s bits, the flips are in the other one
            flips = _masks(range(HALF * (1 - half), HALF * (2 - half)), [s + 1])
            far = odd.filter(F.col("half") == half).select("fingerprint", _each(flips).alias("mask"), F.lit(False).alias("close"))
            variants = variants.unionByName(far)
    variants = variants.select(F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"), "fingerprint", "close")
    least = F.min(F.when(F.col("close"), F.col("fingerprint"))).over(Window.partitionBy("variant"))
    pairs = variants.select("fingerprint", least.alias("centre")).filter("fingerprint <> centre")
    pairs = pairs.select(F.least("fingerprint", "centre").alias("a"), F.greatest("fingerprint", "centre").alias("b")).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, radius: int = 3, seed: int = 42
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row; the component is named by its least doc_id."""
    rows = durable(fingerprints(docs, id_col, text_col, k, seed), "fingerprints")
    mark = scratch_mark()
    known = rows.filter("doc_id IS NOT NULL").groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    known = durable(known, "known")
    labels = durable(components(near_links(known, radius)), "labels")
    placed = known.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    placed = placed.withColumn("label", F.coalesce("label", "fingerprint"))
    least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = placed.join(least, "label").select("fingerprint", "component_id", "n")
    named = durable(named, "named")
    total = named.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = [r["fingerprint"] for r in named.filter(F.col("n") > HOT_SHARE * total).select("fingerprint").collect()]
    drop_scratch(docs.sparkSession, mark, scratch_mark() - 1)  # the result reads the fingerprints and the names only
    found = salted_lookup(rows, named.drop("n"), "fingerprint", hot, "left")
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
