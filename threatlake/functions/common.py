"""Small helpers shared by the Column function modules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing(c) -> Column:
    """``x IS NULL OR x = ''``."""
    c = col_of(c)
    return c.isNull() | (c == "")


def present(c) -> Column:
    c = col_of(c)
    return c.isNotNull() & (c != "")


def nullif_blank(c) -> Column:
    c = col_of(c)
    return F.when(c == "", F.lit(None)).otherwise(c)


def half_up_div(num, den, scale: int = 1, factor: int = 1) -> Column:
    """``ROUND(factor * num / den, scale)`` for non-negative integer-valued ``num`` and
    positive ``den``, rounded half-up in exact integer arithmetic:
    ``(2 * factor * 10^s * num + den) div (2 * den) / 10^s`` as DECIMAL(18+s, s).
    NULL when ``den`` is 0 (the reference guards with NULLIF)."""
    m = 10 ** scale
    n = col_of(num).cast("long")
    d = F.when(col_of(den) == 0, F.lit(None)).otherwise(col_of(den).cast("long"))
    x = n * (2 * factor * m) + d
    y = d * 2
    q = ((x - x % y) / y).cast("long")
    return (q.cast(f"decimal(20,{scale})") / m).cast(f"decimal({18 + scale},{scale})")


def half_up_pct(num, den, scale: int = 1) -> Column:
    """``ROUND(100.0 * num / den, scale)`` of two counts as DECIMAL(4+s, s)."""
    return half_up_div(num, den, scale, factor=100).cast(f"decimal({4 + scale},{scale})")
