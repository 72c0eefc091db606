"""Byte-level text helpers shared by the operators.

Texts reach Python as UTF-8 bytes (``text`` cast to binary), so invalid or very long texts
need no decoding and ``bytes.split`` splits exactly at U+0020 and U+0009-U+000D.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))  # A-Z to a-z, all else kept
SPACES = b" \t\n\x0b\x0c\r"


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made different from every column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def of_text(fn: Callable, fields: str, text: Column | str = "text") -> Column:
    """A struct column of what ``fn(bytes or None) -> tuple`` returns for each text,
    evaluated in Arrow batches. ``fields`` is a DDL string with long, double, boolean, int,
    string, binary or array fields."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(fields)
    arrow = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    @F.arrow_udf(returnType=schema)
    def run(raw: pa.Array) -> pa.Array:
        rows = [fn(v.as_py()) for v in raw]
        cols = list(zip(*rows)) if rows else [()] * len(arrow)
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], fields=arrow)

    col = F.col(text) if isinstance(text, str) else text
    return run(col.cast("binary"))
