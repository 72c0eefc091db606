"""Rank statistics that stay bounded per task however skewed the partition key is."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def percent_rank_within(df: DataFrame, part: str, order: str, out: str) -> DataFrame:
    """``percent_rank() OVER (PARTITION BY part ORDER BY order)`` without sorting whole
    partitions in one task.

    Rows are first counted per distinct ``(part, order)`` value (partial aggregation, so a
    hot ``part`` is combined map-side); the running count is taken over the distinct values
    only — for EPSS that is at most 100 001 values per day whatever the day's row count —
    and joined back on the value. ``(rows strictly below) / (n - 1)``, 0 for a single row.

    The join back is a *left* join on keys the right side holds once: equivalent here
    (every value has its rank row), and it lets Catalyst drop the whole ranking branch
    from plans that never read the rank column.
    """
    counts = df.groupBy(part, order).agg(F.count(F.lit(1)).alias("_n"))
    by_value = Window.partitionBy(part).orderBy(order)
    ranked = counts.select(
        part, order,
        F.coalesce(F.sum("_n").over(by_value.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_below"),
        F.sum("_n").over(Window.partitionBy(part)).alias("_total"),
    ).select(
        part, order,
        F.when(F.col("_total") > 1, F.col("_below") / (F.col("_total") - 1))
         .otherwise(F.lit(0.0)).alias(out),
    )
    return df.join(ranked, [part, order], "left")
