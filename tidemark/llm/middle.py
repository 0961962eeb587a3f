"""Fill-in-the-middle: cut a text at unit borders and move the middle to the end.

Texts are worked on as UTF-8 bytes. Cuts are wanted both in bytes (to slice) and in code points (to report, or to cut
at), so each text gets a **sparse exception index**: the byte places of its multibyte characters only, with the running
sum of the bytes they take beyond one. A binary search in it turns a byte cut into a code-point cut and back; the ASCII
spans between exceptions need no entry, there the two differ by a constant.

Defined results: null text counts as empty; an empty text, and one that holds a sentinel, stays as it is (form
``plain``); a null id draws its cuts like an empty one; equal ids draw equal numbers, so repeated rows give equal
results; very long texts take memory in proportion to their own size; an empty table gives no row; other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINELS = ("<P>", "<S>", "<M>")
UNITS = ("line", "char")
SCHEMA = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, prefix_bytes long, middle_bytes long, "
    "output string"
)


class Exceptions:
    """The multibyte characters of a UTF-8 text: places of their first bytes and running excess."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        self.size = len(raw)
        self.places = np.flatnonzero(raw >= 0xC0)
        first = raw[self.places]
        self.excess = np.zeros(len(first) + 1, np.int64)
        np.cumsum(1 + (first >= 0xE0) + (first >= 0xF0), out=self.excess[1:])

    def chars(self, cut: int) -> int:
        """Code points before a byte cut (a character's border)."""
        return int(cut - self.excess[np.searchsorted(self.places, cut)])

    def bytes(self, cut: int) -> int:
        """Bytes before a code-point cut."""
        return int(cut + self.excess[np.searchsorted(self.places - self.excess[:-1], cut)])


class Lines:
    """Cuts between lines; a line ends behind its line feed or at the end of the text."""

    def __init__(self, data: bytes, index: Exceptions):
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
        if index.size and not (len(ends) and ends[-1] == index.size):
            ends = np.append(ends, index.size)
        self.borders = np.concatenate([[0], ends])
        self.n = len(ends)

    def byte(self, cut: int) -> int:
        return int(self.borders[cut])


class Chars:
    """Cuts between code points."""

    def __init__(self, data: bytes, index: Exceptions):
        self.index = index
        self.n = index.chars(index.size)

    def byte(self, cut: int) -> int:
        return self.index.bytes(cut)


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that belong to a document."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(found[i : i + 4], "big") for i in (0, 4, 8, 12))


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "line",
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, prefix_bytes, middle_bytes, output), one row a document.

    ``n`` counts the units; two of the ``n + 1`` borders, drawn from the id, enclose the middle. ``rate`` percent of the
    documents are transformed, ``spm`` percent of those with the suffix first. Cuts of a plain row are null.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    marks = [s.encode() for s in sentinels]
    before, after, middle = marks

    def one(doc_id: int | None, data: bytes) -> tuple:
        index = Exceptions(data)
        units = (Lines if unit == "line" else Chars)(data, index)
        h1, h2, h3, h4 = draws(seed, doc_id)
        if not data or h3 % 100 >= rate or any(m in data for m in marks):
            return units.n, "plain", None, None, None, None, data
        a, b = (units.byte(cut) for cut in sorted((h1 % (units.n + 1), h2 % (units.n + 1))))
        if h4 % 100 < spm:
            form, parts = "spm", (after, data[b:], before, data[:a], middle, data[a:b])
        else:
            form, parts = "psm", (before, data[:a], after, data[b:], middle, data[a:b])
        first = index.chars(a)
        return units.n, form, first, index.chars(b) - first, a, b - a, b"".join(parts)

    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = [one(i, t.as_py() or b"") for i, t in zip(batch.column(0).to_pylist(), texts)]
            columns = list(zip(*rows)) or [()] * 7
            arrays = [pa.array(values, kind) for values, kind in zip(columns, types)]
            output = pa.array(columns[6], pa.binary()).cast(pa.string())
            names = [field.split()[0] for field in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, output], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def restored(output: str | Column, form: str | Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``fill_in_middle`` has transformed, from its output and form alone."""
    before, after, middle = (rf"\Q{s}\E" for s in sentinels)
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    psm = F.regexp_replace(output, f"(?s)^{before}(.*?){after}(.*?){middle}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{after}(.*?){before}(.*?){middle}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def middle_digest(rows: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with digests in place of the texts."""
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(restored("output", "form"), "UTF-8"), 256).alias("restored_sha256"),
    )
