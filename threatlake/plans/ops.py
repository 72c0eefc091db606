"""Run-health rollups over a fetch log (one row per fetch: feed, status, duration, time,
items) and the cursor table: outcome rates, lag, freshness, latency histograms,
throughput and alert rules. Every rollup is a keyed partial aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from threatlake.operators.snapshots import ts_lit

# Histogram edges (seconds) of the feed-fetch duration, and rows-per-page
# edges of upstream pages.
FETCH_SECONDS_EDGES = [0.5, 1, 2, 5, 10, 30]
PAGE_ROWS_EDGES = [10, 50, 100, 500, 1000, 2000]

# Alert thresholds.
STALE_FEED_SECONDS = 7200
NVD_LAG_SECONDS = 86400
EPSS_LAG_SECONDS = 172800
ERROR_RATE = 0.5


def outcome_rates(log: DataFrame, key: str = "feed_name") -> DataFrame:
    """Fetches by outcome and the success rate per source."""
    g = log.groupBy(key).agg(F.count(F.lit(1)).alias("fetches"),
                             F.count_if(F.col("status") == "success").alias("success"),
                             F.count_if(F.col("status") != "success").alias("errors"))
    return g.withColumn("success_rate", F.col("success") / F.col("fetches")).orderBy(key)


def outcome_pivot(log: DataFrame, key: str = "feed_name", statuses=("success", "error")) -> DataFrame:
    p = log.groupBy(key).pivot("status", list(statuses)).agg(F.count(F.lit(1)))
    return p.select(key, *[F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in statuses]).orderBy(key)


def _epoch(ts):
    return F.unix_timestamp(ts.cast("timestamp"))


def cursor_lag(state: DataFrame, now) -> DataFrame:
    """Seconds between ``now`` and each source's stored cursor."""
    parsed = F.coalesce(F.try_to_timestamp(F.col("cursor")),
                        F.try_to_timestamp(F.col("cursor"), F.lit("yyyy-MM-dd"))).cast("timestamp_ntz")
    return state.select("source", "cursor", (_epoch(ts_lit(now)) - _epoch(parsed)).alias("lag_seconds")) \
        .orderBy("source")


def feed_freshness(log: DataFrame, now, key: str = "feed_name") -> DataFrame:
    """Seconds since each source's last successful fetch (NULL when it never succeeded)."""
    g = log.groupBy(key).agg(F.max(F.when(F.col("status") == "success", F.col("ts"))).alias("last_success"))
    return g.select(key, "last_success", (_epoch(ts_lit(now)) - _epoch(F.col("last_success"))).alias("age_seconds")) \
        .orderBy(key)


def duration_histogram(log: DataFrame, key: str = "feed_name", edges=FETCH_SECONDS_EDGES,
                       value: str = "duration_s", q: float = 0.99) -> DataFrame:
    """Cumulative bucket counts ``le_<edge>`` plus count, sum and p99 per source. The quantile
    comes from counts per duration in microseconds, which merge before the shuffle: a source
    costs as many rows as it has different durations, and no buffer holds them."""
    each = (log.groupBy(key, F.round(F.col(value), 6).alias("v"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(value).cast("decimal(18,3)")).alias("sum")))
    v, n = F.col("v"), F.when(F.col("v").isNotNull(), F.col("rows")).otherwise(0)
    up_to = Window.partitionBy(key).orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = each.withColumn("n", n).withColumn("upto", F.sum(n).over(up_to)).withColumn("all", F.sum(n).over(Window.partitionBy(key)))
    place = (F.col("all") - 1) * F.lit(q)
    at = lambda rank: F.min(F.when((F.col("n") > 0) & (F.col("upto") > rank), v))
    low, high = at(F.floor(place)), at(F.ceil(place))
    share = F.max(place - F.floor(place))
    return (ranked.groupBy(key).agg(
        *[F.sum(F.when(v <= F.lit(e), F.col("n")).otherwise(0)).alias(f"le_{str(e).replace('.', '_')}") for e in edges],
        F.sum("n").alias("count"),
        # summed at millisecond resolution in exact decimal: order-independent result
        F.sum("sum").cast("double").alias("sum"),
        F.round(low + (high - low) * share, 6).alias("p99"))
        .orderBy(key))


def hourly_throughput(log: DataFrame, slide: str | None = None) -> DataFrame:
    """Fetches and items per hour (tumbling; ``slide`` gives sliding windows)."""
    w = F.window("ts", "1 hour", slide) if slide else F.window("ts", "1 hour")
    return (log.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("fetches"),
                                          F.sum("items").cast("long").alias("items"))
            .select(F.col("w.start").alias("hour"), "fetches", "items").orderBy("hour"))


def alert_rules(log: DataFrame, state: DataFrame, now) -> DataFrame:
    """Long form (rule, subject, value, firing) of the recommended alerts."""
    fresh = feed_freshness(log, now).select(
        F.lit("feed_stale").alias("rule"), F.col("feed_name").alias("subject"),
        F.col("age_seconds").cast("double").alias("value"),
        (F.coalesce(F.col("age_seconds"), F.lit(10 ** 12)) > STALE_FEED_SECONDS).alias("firing"))
    lag = cursor_lag(state, now)
    lag_rules = lag.where(F.col("source").isin("NVD", "EPSS")).select(
        F.when(F.col("source") == "NVD", "nvd_behind").otherwise("epss_missed_day").alias("rule"),
        F.col("source").alias("subject"), F.col("lag_seconds").cast("double").alias("value"),
        (F.col("lag_seconds") > F.when(F.col("source") == "NVD", NVD_LAG_SECONDS).otherwise(EPSS_LAG_SECONDS))
        .alias("firing"))
    rates = outcome_rates(log).select(
        F.lit("feed_errors").alias("rule"), F.col("feed_name").alias("subject"),
        (F.col("errors") / F.col("fetches")).alias("value"),
        ((F.col("errors") / F.col("fetches")) > ERROR_RATE).alias("firing"))
    limited = log.agg(F.count_if(F.col("status") == "rate_limited").alias("n")).select(
        F.lit("rate_limited").alias("rule"), F.lit("NVD").alias("subject"), F.col("n").cast("double").alias("value"),
        (F.col("n") > 0).alias("firing"))
    return fresh.unionByName(lag_rules).unionByName(rates).unionByName(limited).orderBy("rule", "subject")


def cves_without_cvss(cve: DataFrame) -> DataFrame:
    return cve.where(F.col("source") == "NVD").agg(
        F.count(F.lit(1)).alias("nvd_cves"), F.count_if(F.col("cvss_base").isNull()).alias("without_cvss"))


def page_size_histogram(page_stats: DataFrame, edges=PAGE_ROWS_EDGES) -> DataFrame:
    r = F.col("rows")
    return page_stats.agg(*[F.count_if(r <= F.lit(e)).alias(f"le_{e}") for e in edges],
                          F.count(F.lit(1)).alias("pages"))
