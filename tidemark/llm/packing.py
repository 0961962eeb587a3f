"""Best-fit packing of token sequences by linear grouping.

1. Texts become ids; only longer ones are cut, into full pieces with the remainder first.
2. The lengths of all pieces are counted: at most ``capacity`` numbers, so the plan is made on the driver from these counts
   and has a bounded size whatever the corpus.
3. Large lengths are sorted, cut into groups of equal cardinality and rounded up to the largest of their group. For the few
   sizes left, configurations are chosen that fill a sequence best, each used as often as it can be.
4. The actual pieces take the places of their group, longest first; what rounding gave away becomes free space again.
5. Small pieces go, longest first, into the sequence that leaves the least space.

The plan names places as ranges of ranks within a length; a distributed rank (a prefix sum over files, then a row number in
each) ties pieces to places. No length, however frequent, is ranked in one task.

Defined results: null text counts as empty and is the end token alone; repeated rows are packed each; an empty table gives
no row; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable

SPECIAL = {"<|endoftext|>": 50256}  # fixed value: the special token of the vocabulary
_encoders: dict[str, object] = {}


def default_vocabulary() -> str:
    """The ranks of byte_bpe_50k: the same vocabulary and ids as its ``.json`` (a test compares them), encoded faster."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _whole(vocabulary: str):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)


def _ranked(vocabulary: str):
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    ranked = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def encode(text: str) -> np.ndarray:
        try:
            return np.array(ranked.encode(text, allowed_special="all"), np.uint32)
        except ValueError:  # its pattern gives up on very long runs of blanks
            return encoder(vocabulary.replace(".tiktoken", ".json"))(text)

    return encode


def encoder(vocabulary: str):
    """Function from text to ids: ``*.json`` of the tokenizers library, or the same vocabulary as ``*.tiktoken`` ranks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = (_whole if vocabulary.endswith(".json") else _ranked)(vocabulary)
    return _encoders[vocabulary]


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 1024, end: int = 2, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of each piece; ids end with the token ``end``."""

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text or ""), np.uint32(end)).astype("<u4")
                first = len(ids) % capacity or capacity
                bounds = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    row = (doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    rows.append((*row, ids[a:b].astype(np.int32)) if with_ids else row)
            columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return narrow.mapInPandas(cut, schema)


class Plan:
    """Places for pieces: (length, first rank, pieces, first sequence, offset), one piece in each sequence of a run."""

    def __init__(self, counts: dict[int, int], capacity: int, groups: int, small: int):
        self.capacity, self.places, self.sequences = capacity, [], 0
        self.used = dict.fromkeys(counts, 0)  # pieces of a length that have a place
        self.free: dict[int, list[tuple[int, int]]] = {}  # runs of sequences (first, number) by free space
        self._large({n: c for n, c in counts.items() if n > small}, groups)
        for length in sorted((n for n in counts if n <= small), reverse=True):
            self._best_fit(length, counts[length])

    def _put(self, length: int, number: int, first: int, offset: int) -> None:
        self.places.append((length, self.used[length], number, first, offset))
        self.used[length] += number

    def _large(self, counts: dict[int, int], groups: int) -> None:
        total = sum(counts.values())
        share = max(1, -(-total // groups))
        runs: dict[int, list[list[int]]] = {}  # by rounded size: [length, pieces], longest first
        size, room = 0, 0
        for length in sorted(counts, reverse=True):
            left = counts[length]
            while left:
                if not room:
                    size, room = length, share
                n = min(left, room)
                runs.setdefault(size, []).append([length, n])
                left, room = left - n, room - n
        left = {s: sum(n for _, n in r) for s, r in runs.items()}
        while left:
            shape = self._configuration(left)
            number = min(left[s] // shape.count(s) for s in shape)
            for s in {*shape}:
                left[s] -= number * shape.count(s)
                if not left[s]:
                    del left[s]
            self._substitute([runs[s] for s in shape], number)

    def _configuration(self, left: dict[int, int]) -> list[int]:
        """The largest size left, and those others that fill the rest best."""
        top = max(left)
        rest = self.capacity - top
        reach, last = np.zeros(rest + 1, bool), np.zeros(rest + 1, np.int64)
        reach[0] = True
        for size in sorted(left, reverse=True):
            for _ in range(min(left[size] - (size == top), rest // size)):
                fresh = reach[: rest + 1 - size] & ~reach[size:]
                if not fresh.any():
                    break
                at = np.flatnonzero(fresh) + size
                reach[at], last[at] = True, size
            if reach[rest]:
                break
        at, shape = int(np.flatnonzero(reach).max()), [top]
        while at:
            shape.append(int(last[at]))
            at -= shape[-1]
        return shape

    def _substitute(self, groups: list[list[list[int]]], number: int) -> None:
        """Give ``number`` sequences of one configuration to actual lengths, in runs in which none changes."""
        first, slots = self.sequences, []
        self.sequences += number
        for runs in groups:
            taken, need = [], number
            while need:
                n = min(need, runs[0][1])
                taken.append((runs[0][0], n))
                runs[0][1] -= n
                need -= n
                if not runs[0][1]:
                    runs.pop(0)
            slots.append(taken)
        while number:
            n = min(slot[0][1] for slot in slots)
            offset = 0
            for slot in slots:
                length, rest = slot[0]
                self._put(length, n, first, offset)
                offset += length
                slot[0] = (length, rest - n)
                if rest == n:
                    slot.pop(0)
            if offset < self.capacity:
                self.free.setdefault(self.capacity - offset, []).append((first, n))
            first, number = first + n, number - n

    def _best_fit(self, length: int, number: int) -> None:
        while number:
            space = min((s for s in self.free if s >= length), default=0)
            if not space:
                fresh = -(-number // (self.capacity // length))
                self.free[self.capacity] = [(self.sequences, fresh)]
                self.sequences += fresh
                continue
            first, n = self.free[space].pop()
            if n > number:
                self.free[space].append((first + number, n - number))
                n = number
            if not self.free[space]:
                del self.free[space]
            self._put(length, n, first, self.capacity - space)
            if space > length:
                self.free.setdefault(space - length, []).append((first, n))
            number -= n


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces``, as read from written files, with the rank of each within its length."""
    rows = pieces.withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    before = Window.partitionBy("length").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("length", "_file").count().select(
        "length", "_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("length", "_file").orderBy("_row")
    placed = rows.withColumn("_place", F.row_number().over(inside) - 1).join(base, ["length", "_file"])
    return placed.withColumn("rank", (F.col("_base") + F.col("_place")).cast("long")).drop("_file", "_row", "_base", "_place")


def best_plan(counts: dict[int, int], capacity: int, groups: int) -> Plan:
    """The plan with the fewest sequences over a few bounds below which a length counts as small."""
    plans = (Plan(counts, capacity, groups, capacity // part) for part in (32, 16, 8, 6, 4, 3))
    return min(plans, key=lambda plan: plan.sequences)


def pack(pieces: DataFrame, capacity: int = 1024, groups: int = 1024) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; large lengths are rounded up within ``groups`` groups."""
    pieces = durable(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    plan = best_plan(counts, capacity, groups)
    places = np.array(sorted(plan.places), np.int64).reshape(-1, 5)
    # One sorted key for length and rank; the plan's size is bounded by lengths, groups and configurations.
    sent = pieces.sparkSession.sparkContext.broadcast(places)
    columns = pieces.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sent.value
        bounds = {n: np.searchsorted(table[:, 0], [n, n + 1]) for n in np.unique(table[:, 0])}
        for batch in batches:
            out = batch[columns].copy()
            ids, offsets = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            for n in np.unique(lengths):
                mine = np.flatnonzero(lengths == n)
                part = table[slice(*bounds[n])]
                at = np.searchsorted(part[:, 1], ranks[mine], "right") - 1
                ids[mine] = part[at, 3] + ranks[mine] - part[at, 1]
                offsets[mine] = part[at, 4]
            out["sequence_id"], out["offset"] = ids, offsets
            yield out

    return ranked(pieces).mapInPandas(place, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces that carry their ids: the training sequences themselves."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most capacity tokens in a group
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
