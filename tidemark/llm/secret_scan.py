"""Secret scan: stated patterns, and a guess-cost dynamic program over values in credential contexts.

The cost of a value is the least log10 of guesses over all its segmentations into dictionary words, dates, repeats,
keyboard or alphabet walks and brute-force spans. A value that stands after a credential word and costs at least
``min_log10`` guesses is a secret of kind ``guess``; values like ``password123`` are not. The word may be a part of an
identifier if a connector follows; without a connector the word stands alone and the value must not look like prose. A
value that goes on behind the span of a stated pattern is a secret as a whole, whatever its price.

Words are a fixed list and the frequent words of the corpus itself (``learn_words``): those that stand free in prose, with
their rank among all documents as the number of guesses. A value that refers to a variable, a subscript or a call, like
``${DB_PASSWORD}``, ``os.environ[`` or ``self.get_password()``, is no value. Passwords in URLs are stated values.

Defined results: null text counts as empty; repeated rows are scanned each; an empty table gives no row; other columns
of the input are ignored. Values of any length are priced in one pass that is linear in the length.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable

# The three stated patterns. Short matches are dropped after matching, never retried.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "guess")
# A credential word anywhere in an identifier; words of prose that only begin like one are none.
KEYWORD = re.compile(
    r"password|passwd|passphrase|passcode|pwd|secret(?!ar|ion|iv|ly|e[ds]?\b)|token(?!i[sz])|api[_-]?key|credential|bearer"
    r"|auth(?!or(?!iz)|entic(?!at))",
    re.IGNORECASE | re.ASCII,
)
REST = re.compile(r"(?:[A-Za-z0-9_]|-(?!>))*+")
STATED = re.compile(r"""["'`]?\s*+(?:[:=]++>?|->)\s*+["'`]?""", re.ASCII)
SAID = re.compile(r"""["']?\s{1,4}+(?:(?:is|was)\s{1,4}+)?["'`]?""", re.IGNORECASE | re.ASCII)
VALUE = re.compile(r"""[^\s"'`<>,;]{8,}+""", re.ASCII)
IN_URL = re.compile(r"""://[^\s"'`<>/:@]*+:([^\s"'`<>/@]{8,}+)@""", re.ASCII)
# References in code, not values: variables of shells and templates, subscripts and calls of names, paths of known owners.
NAME = r"_*+[A-Za-z]++[0-9]{0,3}+(?:_++[A-Za-z]++[0-9]{0,3}+)*+"
OWNERS = (
    "self|this|cls|os|env|environ|process|config|conf|settings|options|args|kwargs|params|props|request|context|ctx|app|vault|"
    "secrets|credentials"
)
VARIABLE = re.compile(r"\$\{[^\s{}]++\}|\$\([^\s()]++\)|\{\{[^\s{}]++\}\}|%[A-Za-z_][A-Za-z0-9_]*+%", re.ASCII)
REFERENCE = re.compile(
    rf"\$(?:{NAME})$|(?:{NAME})(?:\.(?:{NAME}))*+(?:\((?:$|\)|(?:{NAME})[.,)(\[]|(?:{NAME})$)|\[(?:$|(?:{NAME})[\].]|[0-9]++\]))"
    rf"|(?:{OWNERS})(?:\.(?:{NAME}))+[.:)\]}}]*+$",
    re.ASCII,
)
# Frequent passwords and password parts, most frequent first; the place is the number of guesses.
WORDS = (
    "password pass admin welcome letmein login master secret dragon monkey shadow sunshine princess football baseball "
    "superman batman iloveyou love hello freedom whatever michael jordan hunter killer soccer summer winter spring "
    "autumn computer internet test guest root user changeme default temp demo example sample token key api auth access "
    "database server system network office company money secure security private public github google amazon azure "
    "cloud docker production staging service account client none null true false undefined placeholder your here xxx"
).split()
RANK = {word: place for place, word in enumerate(WORDS, 1)}
LONGEST = 24  # letters of the longest word that counts as one
LEARNED = 50_000  # documented bound: most words taken from a corpus
# A word of prose: between blanks or punctuation, and not where a value would stand.
PROSE = r"""(?<![^\s("'])(?<![:=>]["']?\s{0,4}["']?)[A-Za-z][a-z]{3,23}(?=[.,;!?)"']*(?:\s|$))"""
LEET = str.maketrans("@4301$5!7", "aaeoissit")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
NEXT = {pair for row in ROWS for pair in zip(row, row[1:])}
NEXT |= {(b, a) for a, b in NEXT}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|"
                  r"(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")  # fmt: skip
UNIT = 128  # longest unit of a repeat that is priced as one; a longer one takes more than 10^128 guesses
PART = math.log10(4)  # what one more segment costs: the guesser doesn't know where segments end


def learn_words(docs: DataFrame, text_col: str = "text", limit: int = LEARNED) -> dict[str, int]:
    """The words of at most ``limit`` that stand in the most documents, by rank behind the fixed ones.

    All words of all documents are counted. The least count that is taken comes from a histogram of counts in some 500
    classes, so that the driver sees this and the words taken; words of one document only are never taken.
    """
    found = F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(PROSE), 0))
    words = docs.select(F.explode(F.array_distinct(F.transform(found, F.lower))).alias("word"))
    counts = durable(words.groupBy("word").count().filter("count > 1"), "words")
    grade = F.floor(F.log2("count") * 8)
    taken, least = 0, None
    for row in counts.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("grade")).collect():
        if (taken := taken + row.n) > limit:
            break
        least = row.grade
    if least is None:
        return dict(RANK)
    rows = counts.filter(grade >= least).orderBy(F.desc("count"), "word").collect()
    rank = {row.word: place for place, row in enumerate(rows, len(WORDS) + 1)}
    return {**rank, **RANK}


def _segments(value: str, rank: dict[str, int] = RANK) -> Iterator[tuple[int, int, float]]:
    """(start, stop, log10 of guesses) of every pattern in ``value``, without brute force."""
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST) + 1):
            place = rank.get(low[i:j]) or rank.get(plain[i:j])
            if place:
                changed = (low[i:j] not in rank) + any(map(str.isupper, value[i:j]))
                yield i, j, math.log10(place) + changed * math.log10(4)
    for m in DATE.finditer(value):
        yield m.start(), m.end(), math.log10(365 * 120 if m.end() - m.start() > 6 else 12 * 120)
    start = 0
    for i in range(1, n + 1):  # walks: neighbours on a keyboard row, or in the alphabet or digits
        linked = i < n and ((low[i - 1], low[i]) in NEXT or low[i].isalnum() and abs(ord(low[i]) - ord(low[i - 1])) == 1)
        if not linked:
            if i - start >= 3:
                yield start, i, math.log10(40) + 2 * math.log10(i - start)
            start = i
    for unit in _units(value):
        start = 0
        for i in range(unit, n + 1):
            if i == n or value[i] != value[i - unit]:
                if i - start >= max(3, 2 * unit):
                    yield start, i, unit * _per_char(value[start : start + unit]) + math.log10((i - start) / unit)
                start = i - unit + 1


def _units(value: str) -> Iterator[int]:
    """Lengths of the units that may be repeated in ``value``; of more than eight, only those at which it meets itself."""
    n = len(value)
    yield from range(1, min(8, n // 2) + 1)
    if n < 18 or len({value[i : i + 9] for i in range(n - 8)}) == n - 8:
        return
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    for unit in range(9, min(UNIT, n // 2) + 1):
        differ = np.flatnonzero(codes[unit:] != codes[:-unit])
        borders = np.concatenate([[-1], differ, [n - unit]])
        if (np.diff(borders) > unit).any():
            yield unit


def _per_char(part: str) -> float:
    if part.isdigit():
        return 1.0
    if all(c in "0123456789abcdef" for c in part) or all(c in "0123456789ABCDEF" for c in part):
        return math.log10(16)
    size = 26 * (any(map(str.islower, part)) + any(map(str.isupper, part)))
    size += 10 * any(map(str.isdigit, part)) + 20 * (not part.isalnum())
    return math.log10(max(size, 10))


def guess_cost(value: str, rank: dict[str, int] = RANK) -> float:
    """Least log10 of guesses over all segmentations of ``value``."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for start, stop, cost in _segments(value, rank):
        ends.setdefault(stop, []).append((start, cost))
    char = _per_char(value)
    best, brute = 0.0, math.inf  # cheapest price of the prefix; of those, ending in a brute-force span
    prices = [0.0]
    for stop in range(1, len(value) + 1):
        brute = min(brute, best + PART) + char
        best = min([brute, *(prices[start] + PART + cost for start, cost in ends.get(stop, ()))])
        prices.append(best)
    return best


def _said_alone(text: str, start: int, stop: int) -> int:
    """Where the word at ``start`` ends if it stands alone, with a plural s at most; else -1."""
    stop += text[stop : stop + 1] in ("s", "S")
    return -1 if start and _word(text[start - 1]) or _word(text[stop : stop + 1]) else stop


def _word(char: str) -> bool:
    return char == "_" or char.isascii() and char.isalnum()


def context_values(text: str) -> Iterator[tuple[int, str, bool]]:
    """(start, value, whether a connector states it) of the values behind credential words.

    A stated value that begins inside an earlier stated one is left out: it is a part of that one, which costs no less.
    """
    rest = reached = 0
    for m in KEYWORD.finditer(text):
        link, stated = None, False
        if m.end() > rest:  # once for each identifier
            rest = REST.match(text, m.end()).end()
            link = STATED.match(text, rest)
            stated = link is not None
        if not stated and (end := _said_alone(text, m.start(), m.end())) >= 0:
            link = SAID.match(text, end)
        value = VALUE.match(text, link.end()) if link and link.end() >= reached else None
        if not value:
            continue
        found, stop = value[0], value.end()
        if stated and found[-1] == ":" and "\n" in link[0]:
            continue  # the key of the next line
        if stated:
            reached = stop
            if VARIABLE.match(found) or link[0][-1] not in "\"'`" and REFERENCE.match(found):
                continue
        if not (stated and link[0][-1] in "\"'`" and text[stop : stop + 1] == link[0][-1]):
            found = found.rstrip(".:)]}" if stated else ".!?:)]}")
        if len(found) >= 8:
            yield value.start(), found, stated


def find_secrets(text: str, min_log10: float = 10.0, rank: dict[str, int] = RANK) -> list[tuple[int, int, int, float]]:
    """(start, kind number, stop, log10 of guesses) in order. Costs are those of the value, not of the whole span."""
    found, starts, stops = [], [], []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end(), guess_cost(m[2], rank)))
            starts.append(m.start(2))
            stops.append(m.end())
    found += ((m.start(), 1, m.end(), guess_cost(m[0], rank)) for m in ACCESS.finditer(text))
    found += ((m.start(), 2, m.end(), guess_cost(m[0], rank)) for m in HEX.finditer(text))
    seen = 0
    in_urls = ((m.start(1), m[1], True) for m in IN_URL.finditer(text) if not VARIABLE.match(m[1]))
    for start, value, stated in heapq.merge(context_values(text), in_urls):
        stop = start + len(value)
        base = bisect.bisect_right(starts, start) - 1
        held = base >= 0 and start < stops[base]  # a stated pattern holds its beginning, and perhaps all of it
        if start < seen or held and stop <= stops[base]:
            continue
        if held or stated or mixed(value):
            cost = guess_cost(value, rank)
            if held or cost >= min_log10:
                seen = stop
                found.append((start, 3, stop, cost))
    return sorted(found)


def mixed(value: str) -> bool:
    """Prose is letters only, with at most punctuation; a generated value holds a digit or an inner capital."""
    return any(c.isdigit() for c in value) or any(c.isupper() for c in value[1:]) and any(c.islower() for c in value)


def _text(spans: Iterable[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop, *_ in spans)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_log10: float = 10.0
) -> DataFrame:
    """One row per document: ``spans`` array of (start, kind, stop, log10 of guesses) over the whole text."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rank = learn_words(docs, text_col)

    def scan(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [
                [{"start": s, "kind": KINDS[k], "stop": e, "log10_guesses": c} for s, k, e, c in find_secrets(t or "", min_log10, rank)]
                for t in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": spans})

    kind = "array<struct<start:long,kind:string,stop:long,log10_guesses:double>>"
    return narrow.mapInPandas(scan, f"doc_id long, spans {kind}")


def secret_digest(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""

    def text(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    kinds = F.transform("spans", lambda s: s["kind"])
    counts = ((F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS)
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
        F.round(F.array_max(F.transform("spans", lambda s: s["log10_guesses"])), 6).alias("max_log10_guesses"),
    )


def redact_secrets(docs: DataFrame, text_col: str = "text", min_log10: float = 10.0, mask: str = "<SECRET>") -> DataFrame:
    """``docs`` with every found span replaced, all other columns and rows as they are; null text stays null.

    Overlapping spans are replaced as one. ``n_chars`` is counted anew where the input has it.
    """

    rank = learn_words(docs, text_col)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        parts, at = [], 0
        for start, _, stop, _ in find_secrets(text, min_log10, rank):
            if start >= at:
                parts += (text[at:start], mask)
            at = max(at, stop)
        return "".join((*parts, text[at:])) if parts else text

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(clean, na_action="ignore")

    out = docs.withColumn(text_col, cleaned(F.col(text_col)))
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def digest_of(text: str) -> str:
    """What ``secret_digest`` gives for one text; for tests."""
    return hashlib.sha256(_text(s for s in find_secrets(text) if s[1] < 3).encode()).hexdigest()
