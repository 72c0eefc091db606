"""Dashboard panel queries (stat tiles, tables, histograms, time series).

Inputs are the domain tables: ``epss`` (epss_daily), ``cve`` (cve_enriched),
``archive`` / ``current`` (feed items). ``as_of`` replaces NOW(). Every top-k gets the
table key as its last sort column so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threatlake.functions.common import half_up_pct, missing, present
from threatlake.functions.json_fields import kev_field
from threatlake.functions.scores import EPSS_BUCKETS, cvss_bucket, epss_bucket_predicate, in_flag, risk_score
from threatlake.operators.snapshots import (feed_filter, kev, kev_keys, latest_date, latest_snapshot,
                                            mover_order, nvd, ts_lit)

# Default panel thresholds.
EPSS_THRESHOLD = 0.5
CVSS_THRESHOLD = 7.0
FULL_DAY_ROWS = 320_000


def total_cves(cve: DataFrame) -> DataFrame:
    return cve.agg(F.countDistinct("cve_id").alias("total"))


def kev_entries(cve: DataFrame) -> DataFrame:
    return cve.where(F.col("source") == "CISA-KEV").agg(F.count(F.lit(1)).alias("kev_count"))


def critical_cves(cve: DataFrame) -> DataFrame:
    return nvd(cve).where(F.col("cvss_base") >= 9.0).agg(F.count(F.lit(1)).alias("critical"))


def epss_records_latest(epss: DataFrame) -> DataFrame:
    return latest_snapshot(epss).agg(F.count(F.lit(1)).alias("records"))


def _danger(epss, cve, epss_threshold, cvss_threshold):
    e = latest_snapshot(epss).where(F.col("epss") >= F.lit(epss_threshold))
    c = nvd(cve).where(F.col("cvss_base") >= F.lit(cvss_threshold)).select("cve_id", "cvss_base")
    return c.join(e, "cve_id")


def high_risk_count(epss: DataFrame, cve: DataFrame, epss_threshold=EPSS_THRESHOLD,
                    cvss_threshold=CVSS_THRESHOLD) -> DataFrame:
    return _danger(epss, cve, epss_threshold, cvss_threshold).agg(F.count(F.lit(1)).alias("danger_zone"))


def feed_items_window(archive: DataFrame, as_of, days: int = 7) -> DataFrame:
    since = ts_lit(as_of) - F.make_dt_interval(days=F.lit(days))
    return archive.where(F.col("inserted_at") >= since).agg(F.count(F.lit(1)).alias("items"))


def top_exploitable(epss: DataFrame, cve: DataFrame, limit: int = 25) -> DataFrame:
    """Latest day, highest EPSS first, with CVSS (0 when unknown) and the KEV flag."""
    order = [F.col("epss").desc(), F.col("cve_id").asc()]
    # The ranking uses EPSS only and both look-ups are unique per CVE, so the top-k is
    # taken first and only those k CVEs are joined (semi-joined into the look-up scans).
    e = latest_snapshot(epss).orderBy(*order).limit(limit)
    ids = e.select("cve_id")
    c = nvd(cve).join(ids, "cve_id", "left_semi").select("cve_id", "cvss_base")
    k = kev(cve).join(ids, "cve_id", "left_semi").select(F.col("cve_id").alias("kev_cve_id")).distinct()
    return (e.join(c, "cve_id", "left")
             .join(k, e["cve_id"] == k["kev_cve_id"], "left")
             .select("cve_id", "epss", "percentile",
                     F.coalesce("cvss_base", F.lit(0).cast("decimal(3,1)")).alias("cvss_base"),
                     in_flag("kev_cve_id").alias("in_kev"))
             .orderBy(*order))


def movers_latest(epss: DataFrame, min_abs_delta: float = 0.001, limit: int = 25,
                  direction: str = "up") -> DataFrame:
    """Latest day vs the calendar day before, |delta| > 0.001, largest rise first
    (``direction='down'`` / ``'abs'`` surface fallers / any large move)."""
    d = latest_date(epss)
    today = epss.where(F.col("as_of") == d).select(
        "cve_id", F.col("epss").alias("epss_today"), F.col("percentile").alias("percentile_today"))
    yday = epss.where(F.col("as_of") == F.date_sub(d, 1)).select(
        "cve_id", F.col("epss").alias("epss_yesterday"))
    delta = F.col("epss_today") - F.col("epss_yesterday")
    return (today.join(yday, "cve_id")
            .where(F.abs(delta) > F.lit(min_abs_delta))
            .select("cve_id", "epss_today", "epss_yesterday", delta.alias("delta"), "percentile_today")
            .orderBy(*mover_order("delta", direction))
            .limit(limit))


def epss_distribution(epss: DataFrame) -> DataFrame:
    """One wide row of 8 FILTERed counts over the latest day."""
    return latest_snapshot(epss).agg(*[
        F.count_if(epss_bucket_predicate("epss", lo, hi)).alias(label)
        for label, lo, hi in EPSS_BUCKETS])


def epss_distribution_long(epss: DataFrame) -> DataFrame:
    """Long form of the histogram: one row per non-empty bucket."""
    from threatlake.functions.scores import epss_bucket
    return (latest_snapshot(epss).groupBy(epss_bucket("epss").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("cves")).orderBy("bucket"))


def epss_coverage(epss: DataFrame) -> DataFrame:
    today = latest_snapshot(epss).select(F.count(F.lit(1))).scalar()
    return epss.agg(today.cast("long").alias("today"),
                    F.countDistinct("as_of").cast("long").alias("days"),
                    F.count(F.lit(1)).cast("long").alias("total"))


def ingest_health(epss: DataFrame, min_rows: int = FULL_DAY_ROWS, days: int = 7) -> DataFrame:
    """Days among the last ``days`` (relative to the latest) holding >= ``min_rows`` rows."""
    since = F.date_sub(latest_date(epss), days - 1)
    per_day = (epss.where(F.col("as_of") >= since).groupBy("as_of")
               .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows))
    return per_day.agg(F.count(F.lit(1)).cast("long").alias("healthy_days"))


def ingest_log(epss: DataFrame, limit: int = 10) -> DataFrame:
    return (epss.groupBy("as_of").agg(F.count(F.lit(1)).cast("long").alias("records"))
            .orderBy(F.col("as_of").desc()).limit(limit)
            .select(F.col("as_of").cast("string").alias("date"), "records"))


def danger_zone(epss: DataFrame, cve: DataFrame, epss_threshold=EPSS_THRESHOLD,
                cvss_threshold=CVSS_THRESHOLD, limit: int = 50) -> DataFrame:
    """High CVSS x high EPSS on the latest day, ranked by cvss*epss, with risk score."""
    k = kev_keys(cve)
    d = _danger(epss, cve, epss_threshold, cvss_threshold)
    return (d.join(k, d["cve_id"] == k["kev_cve_id"], "left")
             .select("cve_id", "cvss_base", "epss", "percentile",
                     risk_score("cvss_base", "epss").cast("decimal(5,2)").alias("risk_score"),
                     in_flag("kev_cve_id").alias("in_kev"),
                     (F.col("cvss_base") * F.col("epss")).alias("_rank"))
             .orderBy(F.col("_rank").desc(), F.col("cve_id").asc())
             .limit(limit).drop("_rank"))


def cvss_distribution(cve: DataFrame) -> DataFrame:
    return (nvd(cve).where(F.col("cvss_base").isNotNull())
            .groupBy(cvss_bucket("cvss_base").alias("severity"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("severity"))


def nvd_by_modified_day(cve: DataFrame, as_of, days: int = 30) -> DataFrame:
    since = ts_lit(as_of) - F.make_dt_interval(days=F.lit(days))
    c = F.col("cvss_base")
    return (nvd(cve).where(c.isNotNull() & (F.col("modified") >= since))
            .groupBy(F.date_trunc("day", "modified").cast("timestamp_ntz").alias("time"))
            .agg(F.count_if(c >= 9).alias("critical"),
                 F.count_if((c >= 7) & (c < 9)).alias("high"),
                 F.count_if((c >= 4) & (c < 7)).alias("medium"),
                 F.count_if(c < 4).alias("low"))
            .orderBy("time"))


def latest_critical(cve: DataFrame, as_of, days: int = 30, limit: int = 30) -> DataFrame:
    since = ts_lit(as_of) - F.make_dt_interval(days=F.lit(days))
    return (nvd(cve).where((F.col("cvss_base") >= 9.0) & (F.col("modified") >= since))
            .orderBy(F.col("modified").desc(), F.col("cvss_base").desc(), F.col("cve_id").asc())
            .limit(limit)
            .select("cve_id", "cvss_base", F.to_date("modified").alias("modified")))


def kev_latest(cve: DataFrame, limit: int = 25) -> DataFrame:
    k = cve.where(F.col("source") == "CISA-KEV").select(
        "cve_id",
        kev_field("json", "vendorProject").alias("vendor"),
        kev_field("json", "product").alias("product"),
        kev_field("json", "vulnerabilityName").alias("vulnerability"),
        kev_field("json", "dateAdded").alias("date_added"))
    return k.orderBy(F.col("date_added").desc_nulls_first(), F.col("cve_id").asc()).limit(limit)


def feed_volume(archive: DataFrame, as_of, feed_source=None, days: int = 7) -> DataFrame:
    since = ts_lit(as_of) - F.make_dt_interval(days=F.lit(days))
    return (archive.where((F.col("inserted_at") >= since) & feed_filter("feed_url", feed_source))
            .groupBy(F.date_trunc("day", "inserted_at").cast("timestamp_ntz").alias("time"), "feed_title")
            .agg(F.count(F.lit(1)).alias("items"))
            .orderBy("time", "feed_title"))


def content_coverage(current: DataFrame) -> DataFrame:
    has = present("content") | present("summary")
    g = current.groupBy(F.col("feed_url").alias("feed")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(has).alias("has_content"))
    return (g.withColumn("pct_complete", half_up_pct("has_content", "total"))
             .orderBy(F.col("pct_complete").asc(), F.col("feed").asc()))


def latest_items(current: DataFrame, feed_source=None, limit: int = 50) -> DataFrame:
    return (current.where(feed_filter("feed_url", feed_source))
            .orderBy(F.col("inserted_at").desc(), F.col("guid").asc(), F.col("feed_url").asc())
            .limit(limit)
            .select("title", "link", F.col("feed_title").alias("feed"), "published", "categories"))


def feed_list(current: DataFrame) -> DataFrame:
    return current.select("feed_url").distinct().orderBy("feed_url")


def missing_both_flag():
    return missing("content") & missing("summary")
