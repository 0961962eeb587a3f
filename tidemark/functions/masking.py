"""Column masks. Nulls stay null; a mask never shows more than its pattern promises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mask tokens.
REDACTED = "[REDACTED]"
MASKED = "***MASKED***"


def mask_email(col: Column | str) -> Column:
    """First character, ``***@``, domain. Text without an ``@`` is redacted in full."""
    c = F.col(col) if isinstance(col, str) else col
    at = F.instr(c, "@")
    domain = c.substr(at + 1, F.length(c))
    return F.when(c.isNull(), F.lit(None)).when(at == 0, F.lit(REDACTED)).otherwise(
        F.concat(F.left(c, F.lit(1)), F.lit("***@"), domain)
    )


def mask_phone(col: Column | str) -> Column:
    """Everything but the last four characters."""
    c = F.col(col) if isinstance(col, str) else col
    return F.concat(F.lit("***-***-"), F.right(c, F.lit(4)))


def mask_string(col: Column | str, token: str = REDACTED) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNotNull(), F.lit(token))
