"""Request-grammar reads over a relation: projection, filters, order, paging, counts.

``relation_query(df, select=..., filters=[("col", "op", value), ...], order=[...],
offset=0, limit=50)`` is the DataFrame form of ``GET /relation?col=op.value&order=...``
with a ``Range`` header. Column names are checked against the relation's columns, so a
request cannot reach anything the relation does not expose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The server-side cap on rows per response.
MAX_ROWS = 1000

_OPS = {"eq", "neq", "gt", "gte", "lt", "lte", "in", "like", "ilike", "is"}


def _check(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        raise ValueError(f"unknown column {name!r}; allowed: {df.columns}")
    return name


def _like_pattern(v: str) -> str:
    """``*`` is the request wildcard; literal ``%`` / ``_`` are escaped."""
    return v.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("*", "%")


def predicate(df: DataFrame, column: str, op: str, value) -> Column:
    c = F.col(_check(df, column))
    if op not in _OPS:
        raise ValueError(f"unknown operator {op!r}")
    if op == "eq":
        return c == F.lit(value)
    if op == "neq":
        return c != F.lit(value)
    if op == "gt":
        return c > F.lit(value)
    if op == "gte":
        return c >= F.lit(value)
    if op == "lt":
        return c < F.lit(value)
    if op == "lte":
        return c <= F.lit(value)
    if op == "in":
        return c.isin(list(value))
    if op == "like":
        return c.like(_like_pattern(value))
    if op == "ilike":
        return c.ilike(_like_pattern(value))
    # is.true / is.false / is.null
    if value is None or value == "null":
        return c.isNull()
    return c == F.lit(value in (True, "true"))


def order_column(df: DataFrame, spec: str) -> Column:
    """``col``, ``col.asc`` or ``col.desc`` (+ ``.nullsfirst`` / ``.nullslast``); like the
    source database, DESC puts NULLs first and ASC puts them last unless told."""
    parts = spec.split(".")
    c = F.col(_check(df, parts[0]))
    direction = parts[1] if len(parts) > 1 else "asc"
    nulls = parts[2] if len(parts) > 2 else ("nullsfirst" if direction == "desc" else "nullslast")
    if direction == "desc":
        return c.desc_nulls_first() if nulls == "nullsfirst" else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls == "nullsfirst" else c.asc_nulls_last()


def relation_query(df: DataFrame, select=None, filters=(), order=(), offset: int = 0,
                   limit: int | None = None, tiebreak=(), max_rows: int = MAX_ROWS) -> DataFrame:
    """Filter, order (with ``tiebreak`` keys appended for a total order), page, project."""
    for f in filters:
        df = df.where(predicate(df, *f))
    keys = [order_column(df, s) for s in order] + [F.col(_check(df, k)).asc() for k in tiebreak]
    if keys:
        df = df.orderBy(*keys)
    if offset:
        df = df.offset(offset)
    n = max_rows if limit is None else limit  # the cap is for requests without a limit
    df = df.limit(n)
    if select:
        cols = select.split(",") if isinstance(select, str) else list(select)
        df = df.select(*[_check(df, c.strip()) for c in cols])
    return df


def exact_count(df: DataFrame, filters=()) -> DataFrame:
    """The total the page belongs to (``Prefer: count=exact``), as a one-row DataFrame."""
    for f in filters:
        df = df.where(predicate(df, *f))
    return df.agg(F.count(F.lit(1)).alias("count"))
