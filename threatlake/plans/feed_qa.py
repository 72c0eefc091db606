"""Feed content-quality views over the ``current`` feed-item table.

Each per-feed view is one partial+final aggregation keyed by ``feed_url`` — a hot feed is
combined map-side, never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threatlake.functions.common import half_up_pct, missing


def _no_content():
    return missing("content")


def _no_summary():
    return missing("summary")


def _both():
    return missing("content") & missing("summary")


def _count_by_feed(df, name):
    return (df.groupBy("feed_url").agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col("feed_url").asc()))


def missing_both_per_feed(current: DataFrame) -> DataFrame:
    return _count_by_feed(current.where(_both()), "missing_both")


def only_content_missing(current: DataFrame) -> DataFrame:
    return _count_by_feed(current.where(_no_content() & ~_no_summary()), "only_content_missing")


def only_summary_missing(current: DataFrame) -> DataFrame:
    return _count_by_feed(current.where(_no_summary() & ~_no_content()), "only_summary_missing")


def missing_both_entries(current: DataFrame) -> DataFrame:
    return (current.where(_both()).select("feed_url", "title", "link", "published")
            .orderBy(F.col("feed_url").asc(), F.col("published").desc_nulls_first(), F.col("link").asc()))


def missing_both_by_day(current: DataFrame) -> DataFrame:
    return (current.where(_both())
            .groupBy("feed_url", F.date_trunc("day", "published").cast("timestamp_ntz").alias("pub_day"))
            .agg(F.count(F.lit(1)).alias("missing_both"))
            .orderBy(F.col("pub_day").desc_nulls_first(), F.col("feed_url").asc()))


def feed_coverage_summary(current: DataFrame) -> DataFrame:
    g = current.groupBy("feed_url").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_no_content()).alias("content_missing"),
        F.count_if(_no_summary()).alias("summary_missing"),
        F.count_if(_both()).alias("both_missing"))
    return (g.withColumn("percent_both_missing", half_up_pct("both_missing", "total"))
             .orderBy(F.col("percent_both_missing").desc(), F.col("feed_url").asc()))


def most_recent_missing_both(current: DataFrame) -> DataFrame:
    return (current.where(_both()).groupBy("feed_url")
            .agg(F.max("published").alias("most_recent_missing"))
            .orderBy(F.col("most_recent_missing").desc_nulls_first(), F.col("feed_url").asc()))


def missing_both_and_title(current: DataFrame) -> DataFrame:
    return (current.where(_both() & missing("title"))
            .select("feed_url", "title", "link", "published", "content", "summary")
            .orderBy(F.col("published").desc_nulls_first(), F.col("link").asc()))


def percent_missing_both(current: DataFrame) -> DataFrame:
    g = current.groupBy("feed_url").agg(F.count(F.lit(1)).alias("total"),
                                        F.count_if(_both()).alias("missing_both"))
    return (g.withColumn("percent_missing", half_up_pct("missing_both", "total"))
             .orderBy(F.col("percent_missing").desc(), F.col("feed_url").asc()))


def most_affected_titles(current: DataFrame) -> DataFrame:
    return (current.where(_both()).select("feed_url", "title", "link", "published", "content", "summary")
            .orderBy(F.col("feed_url").asc(), F.col("published").desc_nulls_first(), F.col("link").asc()))
