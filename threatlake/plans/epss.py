"""EPSS trend and risk analyses over the daily snapshot table.

Comparisons between days read only the days involved (partition filters on ``as_of``);
per-CVE latest state uses ``max_by`` so it aggregates partially map-side instead of
sorting each CVE's history in one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from threatlake.functions.common import half_up_div, half_up_pct
from threatlake.functions.json_fields import cve_cwe, cve_description
from threatlake.functions.scores import RISK_BAND_OTHER, RISK_BANDS, epss_risk_band, pct_change
from threatlake.operators.snapshots import date_lit, latest_date, latest_snapshot, mover_order, nvd, snapshot


def movers_24h(epss: DataFrame, day, with_percentiles: bool = True, limit: int | None = None,
               direction: str = "up") -> DataFrame:
    """Calendar ``day`` vs the day before, per CVE present on both; largest rise first
    (``direction`` as in ``snapshots.mover_order``)."""
    d = date_lit(day)
    t = epss.where(F.col("as_of") == d).select(
        "cve_id", F.col("epss").alias("epss_today"), F.col("percentile").alias("percentile_today"))
    y = epss.where(F.col("as_of") == F.date_sub(d, 1)).select(
        "cve_id", F.col("epss").alias("epss_yday"), F.col("percentile").alias("percentile_yday"))
    cols = ["cve_id", "epss_today", "epss_yday", (F.col("epss_today") - F.col("epss_yday")).alias("delta")]
    if with_percentiles:
        cols += ["percentile_today", "percentile_yday"]
    out = t.join(y, "cve_id").select(*cols).orderBy(*mover_order("delta", direction))
    return out.limit(limit) if limit else out


def risk_pyramid(epss: DataFrame, day=None) -> DataFrame:
    """Five EPSS risk bands of one day (latest by default): CVE count and share of the day."""
    s = latest_snapshot(epss) if day is None else snapshot(epss, day)
    g = s.groupBy(epss_risk_band("epss").alias("band")).agg(F.count(F.lit(1)).alias("cves"))
    # At most five rows reach this window: the share needs no global sort of the data.
    g = g.withColumn("_total", F.sum("cves").over(Window.partitionBy()))
    total = F.col("_total")
    edge = F.lit(None).cast("decimal(6,5)")
    for e, label in RISK_BANDS:
        edge = F.when(F.col("band") == label, F.lit(e).cast("decimal(6,5)")).otherwise(edge)
    edge = F.when(F.col("band") == RISK_BAND_OTHER, F.lit(0).cast("decimal(6,5)")).otherwise(edge)
    return (g.select("band", edge.alias("min_epss"), "cves", half_up_pct("cves", total).alias("pct_of_day"))
             .orderBy(F.col("min_epss").desc()))


def _pair(epss, day_from, day_to):
    a = epss.where(F.col("as_of") == date_lit(day_from)).select("cve_id", F.col("epss").alias("epss_from"))
    b = epss.where(F.col("as_of") == date_lit(day_to)).select("cve_id", F.col("epss").alias("epss_to"))
    return a.join(b, "cve_id")


def sleepers_between(epss: DataFrame, day_from, day_to, low: float = 0.01, high: float = 0.5) -> DataFrame:
    """CVEs below ``low`` on ``day_from`` and above ``high`` on ``day_to``."""
    p = _pair(epss, day_from, day_to).where((F.col("epss_from") < low) & (F.col("epss_to") > high))
    return (p.select("cve_id", "epss_from", "epss_to",
                     pct_change(F.col("epss_from").cast("double"), F.col("epss_to").cast("double"))
                     .alias("change_pct"))
             .orderBy(F.col("epss_to").desc(), F.col("cve_id").asc()))


def velocity(epss: DataFrame, day_from=None, day_to=None, days: int = 5) -> DataFrame:
    """Movement between two days (default: latest and ``days`` before): surging (> +50 %
    relative from above 0.001), crossed 0.5, crossed 0.1, falling (< -50 % relative)."""
    to = latest_date(epss) if day_to is None else date_lit(day_to)
    frm = F.date_sub(to, days) if day_from is None else date_lit(day_from)
    p = _pair(epss, frm, to)
    a, b = F.col("epss_from"), F.col("epss_to")
    dec = lambda v: F.lit(Decimal(v))  # noqa: E731  exact thresholds on exact scores
    return p.agg(
        F.count_if((a > dec("0.001")) & (b > a * dec("1.5"))).alias("surging"),
        F.count_if((a < dec("0.5")) & (b >= dec("0.5"))).alias("crossed_50"),
        F.count_if((a < dec("0.1")) & (b >= dec("0.1"))).alias("crossed_10"),
        F.count_if((a > dec("0")) & (b < a * dec("0.5"))).alias("falling"))


def universe_growth(epss: DataFrame) -> DataFrame:
    """Per day: CVEs scored, change vs the previous scored day, CVEs not present on the
    first day."""
    first = epss.select(F.min("as_of")).scalar()
    old = epss.where(F.col("as_of") == first).select("cve_id", F.lit(True).alias("_old"))
    per_day = (epss.select("as_of", "cve_id").join(old, "cve_id", "left").groupBy("as_of")
               .agg(F.count(F.lit(1)).alias("cves"), F.count_if(F.col("_old").isNull()).alias("new_since_first")))
    # One row per day reaches the window (days, not CVEs): bounded by the calendar.
    w = Window.orderBy("as_of")
    return (per_day.select("as_of", "cves", (F.col("cves") - F.lag("cves").over(w)).alias("change"), "new_since_first")
            .orderBy("as_of"))


def new_cves(epss: DataFrame) -> DataFrame:
    """CVEs in the latest snapshot that the first one lacks, and the rate per day."""
    first = epss.select(F.min("as_of")).scalar()
    last = latest_date(epss)
    first_ids = epss.where(F.col("as_of") == first).select("cve_id")
    n = epss.where(F.col("as_of") == last).join(first_ids, "cve_id", "left_anti") \
        .agg(F.count(F.lit(1)).alias("new_cves"))
    span = F.datediff(last, first)
    return n.select(first.alias("first_day"), last.alias("latest_day"), "new_cves",
                    span.alias("days"),
                    half_up_div("new_cves", span, 1).cast("decimal(12,1)").alias("per_day"))


def cwe_exploitability(epss: DataFrame, cve: DataFrame, min_epss: float = 0.1) -> DataFrame:
    """Per CWE over latest-day CVEs with EPSS >= ``min_epss``: count, mean EPSS, mean CVSS."""
    e = latest_snapshot(epss).where(F.col("epss") >= F.lit(min_epss)).select("cve_id", "epss")
    c = nvd(cve).select("cve_id", "cvss_base", cve_cwe("json").alias("cwe"))
    j = c.join(e, "cve_id")
    g = j.groupBy("cwe").agg(
        F.count(F.lit(1)).alias("cves"),
        F.sum((F.col("epss") * 100000).cast("long")).alias("_se"),
        F.sum((F.col("cvss_base") * 10).cast("long")).alias("_sc"),
        F.count("cvss_base").alias("_nc"))
    return (g.select("cwe", "cves",
                     half_up_div("_se", F.col("cves") * 100000, 5).cast("decimal(6,5)").alias("avg_epss"),
                     half_up_div("_sc", F.col("_nc") * 10, 2).cast("decimal(5,2)").alias("avg_cvss"))
             .orderBy(F.col("avg_epss").desc(), F.col("cwe").asc()))


def apex(epss: DataFrame, cve: DataFrame, min_epss: float = 0.5, min_cvss: float = 9.0,
         limit: int | None = None) -> DataFrame:
    """Latest-day CVEs where EPSS and CVSS both clear their thresholds."""
    e = latest_snapshot(epss).where(F.col("epss") >= F.lit(min_epss)).select("cve_id", "epss")
    c = nvd(cve).where(F.col("cvss_base") >= F.lit(min_cvss)).select(
        "cve_id", "cvss_base", cve_description("json").alias("description"))
    out = (c.join(e, "cve_id").select("cve_id", "epss", "cvss_base", "description")
           .orderBy(F.col("epss").desc(), F.col("cvss_base").desc(), F.col("cve_id").asc()))
    return out.limit(limit) if limit else out


def _calendar(epss, until=None):
    bounds = epss.agg(F.min("as_of").alias("lo"), F.max("as_of").alias("hi"))
    hi = F.col("hi") if until is None else date_lit(until)
    return bounds.select(F.explode(F.sequence(F.col("lo"), hi, F.expr("INTERVAL 1 DAY"))).alias("as_of"))


def coverage_gaps(epss: DataFrame, until=None) -> DataFrame:
    """Calendar days between the first snapshot and ``until`` (default: latest) with no rows."""
    present = epss.select("as_of").distinct()
    return _calendar(epss, until).join(present, "as_of", "left_anti").orderBy("as_of")


def coverage_summary(epss: DataFrame, until=None) -> DataFrame:
    """Days present vs calendar days expected ("32 of 39")."""
    expected = _calendar(epss, until).agg(F.count(F.lit(1)).alias("days_expected"))
    return epss.agg(F.countDistinct("as_of").alias("days_present"),
                    expected.scalar().alias("days_expected"))


def feed_cadence(archive: DataFrame, ts_col: str = "published") -> DataFrame:
    """Articles per ISO week (weeks start on Monday)."""
    return (archive.groupBy(F.to_date(F.date_trunc("week", ts_col)).alias("week"))
            .agg(F.count(F.lit(1)).alias("articles")).orderBy("week"))


def feed_cadence_by_month(archive: DataFrame, ts_col: str = "published") -> DataFrame:
    """Average articles per week for each month (a week counts in the month it starts in),
    rounded half-up to one decimal; also the number of weeks and the busiest week."""
    weekly = archive.groupBy(F.to_date(F.date_trunc("week", ts_col)).alias("week")) \
        .agg(F.count(F.lit(1)).alias("articles"))
    g = weekly.groupBy(F.date_trunc("month", "week").cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("articles").alias("articles"),
        F.max("articles").alias("peak_week_articles"))
    return (g.select("month", "weeks", "articles",
                     half_up_div("articles", "weeks", 1).cast("decimal(12,1)").alias("avg_per_week"),
                     "peak_week_articles")
             .orderBy("month"))


def top_feeds(archive: DataFrame, limit: int | None = None) -> DataFrame:
    """Articles per feed and share of all articles."""
    g = archive.groupBy(F.col("feed_title").alias("feed")).agg(F.count(F.lit(1)).alias("articles"))
    # One row per feed reaches the window: bounded by the feed registry, not the items.
    g = g.withColumn("_total", F.sum("articles").over(Window.partitionBy()))
    total = F.col("_total")
    out = (g.select("feed", "articles", half_up_pct("articles", total).alias("share_pct"))
            .orderBy(F.col("articles").desc(), F.col("feed").asc()))
    return out.limit(limit) if limit else out


def epss_latest(epss: DataFrame) -> DataFrame:
    """Newest row per CVE (not per global day)."""
    # Fixed-width columns one by one: a struct would make it a sort-based aggregate.
    return epss.groupBy("cve_id").agg(F.max("as_of").alias("as_of"), F.max_by("epss", "as_of").alias("epss"),
                                      F.max_by("percentile", "as_of").alias("percentile"))
