"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust the score. JVM only.

Positions count code points. ``split`` and ``regexp_extract_all`` walk the same matches, so the lengths of the pieces
between them give every start. The patterns are the stated ones with possessive repeats, which match the same text
without deep recursion on long runs; the look-behinds only skip starts inside a run whose first character has failed.

Defined results: null text counts as empty; spans of different kinds may overlap and repeated rows are scanned each;
an empty table gives no row; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    n = F.length(digits(match))
    return n.between(14, 19) & F.call_function("luhn_check", digits(match))


def octets(match: Column) -> Column:
    one = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return match.rlike(rf"^{one}\.{one}\.{one}\.{one}$")


def phone_digits(match: Column) -> Column:
    return F.length(digits(match)).between(10, 15)


def mod97(match: Column) -> Column:
    """The check of an international bank account number: letters count from 10, the number modulo 97 is 1."""
    flat = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substring(flat, 5, 34), F.substring(flat, 1, 4))

    def step(acc: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97

    return F.length(flat).between(15, 34) & (F.aggregate(F.split(moved, "(?!$)"), F.lit(0), step) == 1)


def plausible_ssn(match: Column) -> Column:
    return ~match.rlike("^(?:000|666|9)|-00-|-0000$")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    gate: object  # a cheap test that texts without a span fail
    valid: object
    score: float
    context: str  # words that raise the score when they stand nearby
    base: bool = True


# Characters of an account number by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """The length of the country comes first, so that a next word in capitals stays outside; other lengths by the form."""
    forms = []
    for length, codes in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{last}")
    forms.append(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?")
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


# The four base patterns and context words are fixed values.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: t.contains("@"), lambda m: F.lit(True), 0.8, "mail|contact|write|reply|address",
    ),
    Kind(
        "ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"), octets, 0.6, r"(?:^|[^a-z0-9_])ip(?:$|[^a-z0-9_])|host|server|address|client|login",
    ),
    Kind(
        "card", r"[0-9](?:[\x20-]?+[0-9])++",
        lambda t: t.rlike(r"(?:[0-9][\x20-]?){13}[0-9]"), luhn, 0.6, "card|visa|master|amex|credit|debit|pay",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda t: t.contains("+"), phone_digits, 0.5, "phone|call|mobile|cell|tel|fax|whatsapp",
    ),
    Kind(
        "iban", _iban(),
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), mod97, 0.8, "iban|account|bank|transfer|swift", False,
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), plausible_ssn, 0.3, "ssn|social|security|insurance", False,
    ),
)
BOOST, NEAR, THRESHOLD = 0.3, 50, 0.5
BLOCK = 256
_SPAN = "struct<start:int,kind:int,stop:int,score:double>"


def _width(pair: Column) -> Column:
    return F.length(pair["gap"]) + F.coalesce(F.length(pair["hit"]), F.lit(0))


def _with_spans(df: DataFrame, number: int, kind: Kind) -> DataFrame:
    """``df`` and a column of the valid spans of one kind, each with its score.

    Matches are worked on in blocks of ``BLOCK``, so that a text with very many of them takes linear time.
    """
    text = F.col("text")
    none = F.array().cast(f"array<{_SPAN}>")
    pairs = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(kind.pattern), 0).alias("hit")
    )
    last = F.floor((F.size("_pairs") - 1) / BLOCK).cast("int")

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + F.length(x["gap"])
        stop = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        near = F.lower(F.substring(text, F.greatest(start - NEAR, F.lit(0)) + 1, stop - start + 2 * NEAR))
        score = F.lit(kind.score) + F.when(near.rlike(kind.context), F.lit(BOOST)).otherwise(F.lit(0.0))
        span = F.struct(
            start.alias("start"), F.lit(number).alias("kind"), stop.alias("stop"), score.alias("score")
        ).cast(_SPAN)
        valid = x["hit"].isNotNull() & kind.valid(x["hit"])
        if not kind.base:
            valid = valid & (score >= THRESHOLD)
        return F.struct(
            stop.alias("pos"), F.when(valid, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")
        )

    def spans(block: Column, i: Column) -> Column:
        base = F.aggregate(F.slice("_sizes", F.lit(1), i), F.lit(0), lambda a, n: a + n)
        return F.aggregate(block, F.struct(base.alias("pos"), none.alias("out")), step, lambda acc: acc["out"])

    blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice("_pairs", b * BLOCK + 1, F.lit(BLOCK)))
    sizes = F.transform("_blocks", lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + _width(x)))
    return (
        df.withColumn("_pairs", F.when(kind.gate(text), pairs))
        .withColumn("_blocks", blocks)
        .withColumn("_sizes", sizes)
        .withColumn(f"_{number}", F.coalesce(F.flatten(F.transform("_blocks", spans)), none))
        .drop("_pairs", "_blocks", "_sizes")
    )


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``spans`` array of (start, kind number, stop, score), by start and kind."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = reduce(lambda df, x: _with_spans(df, *x), enumerate(KINDS), narrow)
    return found.select("doc_id", F.array_sort(F.concat(*(f"_{i}" for i in range(len(KINDS))))).alias("spans"))


def _text(spans: Column) -> Column:
    names = F.array(*(F.lit(k.name) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ","
    )


def pii_digest(spans: DataFrame) -> DataFrame:
    """Counts per kind, a digest of the base spans, and all spans and scores as text."""
    base = sum(k.base for k in KINDS)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = (
        (F.size("spans") - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k.name}") for i, k in enumerate(KINDS)
    )
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(_text(F.filter("spans", lambda s: s["kind"] < base)), 256).alias("base_sha256"),
        _text(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"),
    )
