"""Language identification by language-bitmask n-gram filters.

The filters are bit-sliced Bloom filters: one table of ``2**bits`` words in which bit ``l`` belongs to language ``l``. The
AND of an n-gram's ``HASHES`` words gives all languages that contain it at once. Per language the hits are counted, the
expected false positives are taken off (fill rate to the power of the number of hashes), and the largest share wins.

N-grams are trigrams of letters; a letter of a script with thousands of them is an n-gram by itself. A language's filter
holds its ``max_grams`` most frequent ones: of those that are equally frequent at the border, a share chosen by hash. So
every labelled language with a letter has a filter, of bounded size whatever the corpus, that can be sent to tasks; a
hit counts the more the less of its language's n-grams the filter covers. Counts cover every training document.

Defined results: null text, text without a letter, or no learned language give ``und`` with score 0; ties go to the
first language by name; repeated rows are judged each; other columns of the input are ignored. Rows with a null id or
label are judged but not learned from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

HASHES = 2
MAX_LANGUAGES = 4096  # documented bound: more distinct labels than this are no languages
SLICE = 1 << 20  # characters worked on at once
_BLANK = 32
WIDE = 0x2E80  # from here on scripts have thousands of letters (ideographs, syllables)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_letters: np.ndarray | None = None


def _table() -> np.ndarray:
    """Lower-case letter of each code point, or a blank for what is no letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter(
            (ord(chr(c).lower()[0]) if chr(c).isalpha() else _BLANK for c in range(0x110000)), np.uint32, 0x110000
        )
    return _letters


def _hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all trigrams and the place of their text. A text is padded with blanks; runs of blanks are one."""
    joined = "\n".join(["", *texts, ""])
    codes = _table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts) + 1), np.concatenate([[1], sizes + 1]))  # the blank after a text is its own
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    if len(codes) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # a wide letter stands alone; to its neighbours it is a blank
    alone, narrow = codes[1:-1] >= WIDE, np.where(codes >= WIDE, np.uint64(_BLANK), codes)
    left, right = (np.where(alone, np.uint64(1), side) for side in (narrow[:-2], narrow[2:]))
    h = left * _MIX[0] ^ codes[1:-1] * _MIX[1] ^ right * _MIX[2]
    h ^= h >> np.uint64(29)
    h *= _MIX[0]
    h ^= h >> np.uint64(32)
    middle = codes[1:-1] != _BLANK  # a blank in the middle joins two words
    return h[middle], owner[1:-1][middle] - 1


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about ``SLICE`` characters; a longer text is a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def ngram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``train`` (text, lang); counted in the tasks first."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                mine = totals.setdefault(lang, {})
                for _, texts in _slices(rows["text"].tolist()):
                    grams, n = np.unique(_hashed(texts)[0], return_counts=True)
                    for g, k in zip(grams.view(np.int64).tolist(), n.tolist()):
                        mine[g] = mine.get(g, 0) + k
                if len(mine) > 500_000:  # bounded memory; what is emitted early is summed by the shuffle
                    yield pd.DataFrame({"lang": lang, "gram": list(mine), "n": list(mine.values())})
                    mine.clear()
        for lang, mine in totals.items():
            if mine:
                yield pd.DataFrame({"lang": lang, "gram": list(mine), "n": list(mine.values())})

    rows = train.select("lang", "text").dropna().mapInPandas(count, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Filters:
    languages: list[str]
    words: np.ndarray  # 2**bits rows, one 64-bit word for each 64 languages
    fill: np.ndarray  # share of set bits of each language
    covered: np.ndarray  # share of each language's n-grams, with repeats, that its filter holds

    @property
    def bits(self) -> int:
        return int(len(self.words)).bit_length() - 1


def _places(grams: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield ((grams >> np.uint64(k * bits)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def learn(train: DataFrame, max_grams: int = 50_000, bits: int = 20) -> Filters:
    """Filters from ``train`` (text, lang). What is collected is bounded: about ``max_grams`` n-grams a language."""
    counts = ngram_counts(train).withColumn("level", F.floor(4 * F.log2("n")).cast("int"))
    counts = durable(counts, "grams")
    levels = counts.groupBy("lang", "level").agg(F.count("*").alias("grams"), F.sum("n").alias("n"))
    found = levels.limit(256 * MAX_LANGUAGES + 1).toPandas()  # at most 256 levels of a language
    if len(found) > 256 * MAX_LANGUAGES or found["lang"].nunique() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    cuts, covered = [], {}
    for lang, mine in found.sort_values("level", ascending=False).groupby("lang"):
        held = mine["grams"].cumsum()
        border = mine[held > max_grams].head(1)  # the level that doesn't fit as a whole
        level = int(border["level"].iloc[0]) if len(border) else -1
        above = mine[mine["level"] > level]
        share = (max_grams - int(above["grams"].sum())) / int(border["grams"].iloc[0]) if len(border) else 0.0
        cuts.append((lang, level, share))
        covered[lang] = (above["n"].sum() + share * border["n"].sum()) / mine["n"].sum()
    if not cuts:
        return Filters([], np.zeros((1 << bits, 1), np.uint64), np.zeros(0), np.zeros(0))
    cut = train.sparkSession.createDataFrame(cuts, "lang string, cut int, share double")
    chosen = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    kept = counts.join(F.broadcast(cut), "lang").filter((F.col("level") > F.col("cut")) | ((F.col("level") == F.col("cut")) & chosen))
    rows = kept.select("lang", "gram").toPandas()
    languages = sorted(covered)
    words = np.zeros((1 << bits, -(-len(languages) // 64)), np.uint64)
    fill = np.zeros(len(languages))
    for number, lang in enumerate(languages):
        grams = rows.loc[rows["lang"] == lang, "gram"].to_numpy(np.int64).view(np.uint64)
        places = np.unique(np.concatenate(list(_places(grams, bits))))
        words[places, number // 64] |= np.uint64(1 << (number % 64))
        fill[number] = len(places) / len(words)
    return Filters(languages, words, fill, np.array([covered[lang] for lang in languages]))


def judge(texts: list[str], filters: Filters) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text: the largest share of contained n-grams after the correction."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    if not filters.languages:
        return names, scores
    false_rate = np.minimum(filters.fill**HASHES, 0.99)
    for start, part in _slices(texts):
        grams, owner = _hashed(part)
        if not len(grams):
            continue
        first, second = _places(grams, filters.bits)
        hit = filters.words[first] & filters.words[second]
        total = np.bincount(owner, minlength=len(part))
        shares = np.empty((len(filters.languages), len(part)))
        for number in range(len(filters.languages)):
            bit = (hit[:, number // 64] >> np.uint64(number % 64)) & np.uint64(1)
            n = np.bincount(owner, weights=bit, minlength=len(part))
            expected = total * false_rate[number]
            shares[number] = (n - expected) / np.maximum(total - expected, 1e-9) / max(filters.covered[number], 1e-9)
        best = shares.argmax(0)
        for i in np.flatnonzero(total):
            names[start + i] = filters.languages[best[i]]
            scores[start + i] = min(max(float(shares[best[i], i]), 0.0), 1.0)
    return names, scores


def predict(docs: DataFrame, filters: Filters, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, then ``lang_pred`` and ``score`` of its ``text``."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[keep].copy()
            out["lang_pred"], out["score"] = judge([t or "" for t in batch["text"]], sent.value)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    columns = [*keep, *({"text"} - {*keep})]
    return docs.select(*columns).mapInPandas(run, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Learn from three quarters of the labelled rows by a checksum of the id, then judge every row."""
    rest = F.crc32(F.col(id_col).cast("string")) % 4
    train = docs.filter((rest != 2) & F.col("lang").isNotNull()).select("lang", "text")
    filters = learn(train)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "text"
    )
    return predict(rows, filters, ["doc_id", "held_out"])


def keep_identified(docs: DataFrame, min_score: float = 0.2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language: not ``und``, and a score of at least ``min_score``.

    The bound is low on purpose: a short text with an address or a key in it scores 0.45 and is clean.

    All columns stay as they are, and the label plays no part in the decision. Filters are learned as in ``identify``.
    """
    rest = F.crc32(F.col(id_col).cast("string")) % 4
    train = docs.filter((rest != 2) & F.col("lang").isNotNull())
    sent = docs.sparkSession.sparkContext.broadcast(learn(train.select(F.col(text_col).alias("text"), "lang")))

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        names, scores = judge([t or "" for t in texts], sent.value)
        return pd.Series([n != "und" for n in names]) & (scores >= min_score)

    return docs.filter(found(F.col(text_col)))
