"""The feed registry dimension (name, url, feed type, tags) and its join to items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

REGISTRY = T.StructType([
    T.StructField("name", T.StringType(), False), T.StructField("url", T.StringType(), False),
    T.StructField("feed_type", T.StringType(), True), T.StructField("tags", T.ArrayType(T.StringType()), True),
])


def registry_from_config(spark: SparkSession, feeds: list[dict]) -> DataFrame:
    """Registry rows from a configuration list (a few dozen feeds)."""
    rows = [(f["name"], f["url"], f.get("feed_type"), list(f.get("tags", []))) for f in feeds]
    return spark.createDataFrame(rows, REGISTRY)


def registry_from_items(items: DataFrame) -> DataFrame:
    """A registry derived from the feeds seen in the items: type by URL suffix, tags from
    the languages the feed publishes in (distinct, sorted)."""
    g = items.groupBy("feed_url").agg(F.array_sort(F.collect_set("feed_language")).alias("tags"))
    ftype = F.when(F.col("feed_url").rlike(r"(?i)atom"), "atom").otherwise("rss")
    return g.select(F.concat(F.lit("Feed "), F.col("feed_url")).alias("name"), F.col("feed_url").alias("url"),
                    ftype.alias("feed_type"), "tags")


def attach_registry(items: DataFrame, registry: DataFrame) -> DataFrame:
    """Items with their feed's name, type and tags. The registry is a small dimension;
    Catalyst/AQE choose a broadcast when its measured size is under the threshold."""
    r = registry.select(F.col("url").alias("feed_url"), F.col("name").alias("feed_name"), "feed_type", "tags")
    return items.join(r, "feed_url", "left")


def volume_by_type_and_tag(items: DataFrame, registry: DataFrame) -> DataFrame:
    j = attach_registry(items, registry)
    return (j.select("feed_type", F.explode_outer("tags").alias("tag"))
            .groupBy("feed_type", "tag").agg(F.count(F.lit(1)).alias("items"))
            .orderBy("feed_type", "tag"))
