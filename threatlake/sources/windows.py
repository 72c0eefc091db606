"""Incremental selection windows and page-set completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatlake.operators.snapshots import ts_lit

# The largest publication-date window the upstream API accepts, and the
# start used when no usable cursor is stored.
MAX_WINDOW_DAYS = 120
DEFAULT_CURSOR = "2000-01-01T00:00:00Z"


def cursor_start(cursor) -> Column:
    """Stored cursor text -> TIMESTAMP_NTZ; unparseable or missing -> 2000-01-01."""
    c = cursor if isinstance(cursor, Column) else F.lit(cursor)
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(F.lit(DEFAULT_CURSOR))).cast("timestamp_ntz")


def window_plan(spark: SparkSession, cursor, now, days: int = MAX_WINDOW_DAYS) -> DataFrame:
    """Consecutive windows from the cursor to ``now`` (the last one clipped to ``now``),
    with the cursor value stored after each window."""
    start, end = cursor_start(cursor), ts_lit(now)
    step = F.make_dt_interval(days=F.lit(days))
    one = spark.range(1).select(start.alias("s"), end.alias("e"))
    # the upper bound never falls below the start (a cursor already past "now" yields
    # one candidate that the filter drops), so the sequence is always well-formed
    last = F.greatest(F.col("s"), F.col("e") - F.make_dt_interval(secs=F.lit(1)))
    starts = one.select(F.explode(F.sequence("s", last, step)).alias("w_start"), "e") \
        .where(F.col("w_start") < F.col("e"))
    return starts.select(
        "w_start", F.least(F.col("w_start") + step, F.col("e")).alias("w_end"),
        F.date_format(F.least(F.col("w_start") + step, F.col("e")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("cursor_after")
    ).orderBy("w_start")


def select_windowed(df: DataFrame, ts_col: str, cursor, now, days: int = MAX_WINDOW_DAYS) -> DataFrame:
    """Rows with ``cursor <= ts < now`` tagged with their window ``[w_start, w_end)``.
    The window is arithmetic on the timestamp, so no join with the plan is needed."""
    start, end = cursor_start(cursor), ts_lit(now)
    ts = F.col(ts_col).cast("timestamp_ntz")
    secs = F.unix_timestamp(ts.cast("timestamp")) - F.unix_timestamp(start.cast("timestamp"))
    idx = F.floor(secs / F.lit(days * 86400)).cast("int")
    w_start = start + F.make_dt_interval(days=idx * days)
    return (df.where((ts >= start) & (ts < end))
            .withColumn("w_start", w_start)
            .withColumn("w_end", F.least(F.col("w_start") + F.make_dt_interval(days=F.lit(days)), end)))


def page_completeness(page_stats: DataFrame, snapshot_col: str) -> DataFrame:
    """Per snapshot: pages, rows loaded, declared total and whether the set is complete
    (a short set must not count as loaded)."""
    return (page_stats.groupBy(snapshot_col).agg(
        F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("loaded"), F.max("total").alias("total"))
        .withColumn("complete", F.col("loaded") >= F.col("total"))
        .orderBy(snapshot_col))
