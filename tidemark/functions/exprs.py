"""Business expressions shared by the layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The end of an open validity interval, the two reserved surrogate keys, and the order states
# that do not count as revenue.
FAR_FUTURE = "2099-12-31"
UNKNOWN_KEY = -1
ORGANIC_KEY = -2
NON_REVENUE_STATES = ("CANCELLED", "RETURNED")

_NULL_MARK = "\u0000"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def change_hash(*cols: Column | str) -> Column:
    """MD5 over ``||``-joined values; a null has its own mark so moving it between columns changes the hash."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(_NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws("||", *parts))


def hash_key(*cols: Column | str) -> Column:
    """Surrogate key as an MD5 of natural key parts (for example customer id and valid-from)."""
    return change_hash(*cols)


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives NULL instead of an error when the denominator is zero."""
    return F.try_divide(_c(numerator), _c(denominator))


def money(col: Column | str) -> Column:
    return _c(col).cast("decimal(15,2)")


def year_month(col: Column | str) -> Column:
    """Gold partition value: INT ``yyyyMM``."""
    return (F.year(_c(col)) * 100 + F.month(_c(col))).cast("int")


def year_month_text(col: Column | str) -> Column:
    """Silver partition value: ``yyyy-MM``."""
    return F.date_format(_c(col), "yyyy-MM")


def date_key(col: Column | str) -> Column:
    """INT ``yyyyMMdd``."""
    c = _c(col)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def allocate(line_total: Column | str, subtotal: Column | str, amount: Column | str) -> Column:
    """Share of a header amount that belongs to a line.

    Multiplies before dividing, so the product is exact and only the last step rounds.
    """
    return F.try_divide(_c(line_total) * _c(amount), _c(subtotal)).cast("decimal(15,2)")


def nps_category(score: Column | str) -> Column:
    s = _c(score)
    return (
        F.when(s.between(0, 6), F.lit("Detractor"))
        .when(s.between(7, 8), F.lit("Passive"))
        .when(s.between(9, 10), F.lit("Promoter"))
    )


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.concat_ws(" ", _c(first), _c(last))


def is_organic(channel: Column | str) -> Column:
    return F.coalesce(F.upper(F.trim(_c(channel))) == "ORGANIC", F.lit(False))


def lifespan_days(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_c(end), _c(start))


def elapsed_months(start: Column | str, end: Column | str) -> Column:
    """Whole months between two dates."""
    return F.timestamp_diff("MONTH", _c(start).cast("timestamp"), _c(end).cast("timestamp"))


def lifespan_months(last_order: Column | str, registered: Column | str, churned: Column | str) -> Column:
    """Whole months from registration to last order, with the churn date as the latest end."""
    end = F.least(_c(last_order).cast("date"), F.coalesce(_c(churned).cast("date"), F.lit(FAR_FUTURE).cast("date")))
    return elapsed_months(registered, end)


def per_30_days(orders: Column | str, days: Column | str) -> Column:
    """Orders per 30 days; NULL for an empty span. Multiplies first, so no digit is lost in ``days / 30``."""
    return F.try_divide(_c(orders) * 30, _c(days))


def span_frequency(orders: Column | str, first: Column | str, last: Column | str) -> Column:
    """Orders per 30 days between first and last order; NULL when both fall on one day."""
    return per_30_days(orders, F.datediff(_c(last), _c(first)))
