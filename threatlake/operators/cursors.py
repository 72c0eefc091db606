"""Ingest cursors as an append-only log.

Every advance of a source's cursor is a new entry; the state is the newest entry of each
source. Nothing is overwritten, so several streams may share one log and a crash between two
steps never reads as "no cursors": the entries written before it stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threatlake.operators.storage import read_if_exists
from threatlake.operators.tables import empty_state


def newest_cursors(log: DataFrame) -> DataFrame:
    """(source, cursor): the newest entry of each source (of entries of one instant, the largest cursor)."""
    return log.groupBy("source").agg(F.max(F.struct("at", "cursor")).alias("e")).select("source", F.col("e.cursor").alias("cursor"))


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    log = read_if_exists(spark, path)
    return empty_state(spark) if log is None else newest_cursors(log)


def append_cursor(spark: SparkSession, path: str, source: str, value) -> None:
    """Enter ``value`` (a literal or scalar Column) as the cursor of ``source``; null enters nothing."""
    v = value if isinstance(value, Column) else F.lit(value)
    entry = spark.range(1).select(F.lit(source).alias("source"), v.cast("string").alias("cursor"),
                                  F.current_timestamp().cast("timestamp_ntz").alias("at"))
    entry.where("cursor is not null").coalesce(1).write.mode("append").parquet(path)
