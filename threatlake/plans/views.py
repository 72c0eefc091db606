"""SQL surface: every table, view and documented relation as a Spark temporary view under
the name users of the source system query today, plus the three SQL functions.

``register_views(spark, tables, as_of)`` is lazy — each view is a DataFrame plan, nothing
runs until a query uses it — so ``spark.sql("SELECT ... FROM cve_detail WHERE in_kev")``
is planned by Catalyst end to end (filters push through the views into the scans).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from threatlake.functions.urls import register_sql_functions
from threatlake.plans import dashboards as dsh
from threatlake.plans import epss as eps
from threatlake.plans import feed_qa as qa
from threatlake.plans import relations as rel


def view_plans(tables, as_of, movers_day) -> dict:
    """name -> zero-argument builder of the view's DataFrame."""
    t = tables
    latest = lambda: getattr(t, "epss_latest", None)  # noqa: E731  maintained table, when stored
    mentions = lambda: rel.cve_mentions(t.analysis)
    rollups = lambda: rel.campaign_cve_rollups(t.analysis, t.cve_enriched, t.epss_daily, latest())
    return {
        # stored tables
        "epss_daily": lambda: t.epss_daily, "cve_enriched": lambda: t.cve_enriched,
        "archive": lambda: t.archive, "current": lambda: t.current, "analysis": lambda: t.analysis,
        # feed QA views
        "v_missing_both_per_feed": lambda: qa.missing_both_per_feed(t.current),
        "v_only_content_missing": lambda: qa.only_content_missing(t.current),
        "v_only_summary_missing": lambda: qa.only_summary_missing(t.current),
        "v_missing_both_entries": lambda: qa.missing_both_entries(t.current),
        "v_missing_both_by_day": lambda: qa.missing_both_by_day(t.current),
        "v_feed_coverage_summary": lambda: qa.feed_coverage_summary(t.current),
        "v_most_recent_missing_both": lambda: qa.most_recent_missing_both(t.current),
        "v_missing_both_and_title": lambda: qa.missing_both_and_title(t.current),
        "v_percent_missing_both": lambda: qa.percent_missing_both(t.current),
        "v_most_affected_titles": lambda: qa.most_affected_titles(t.current),
        "v_epss_movers_24h": lambda: eps.movers_24h(t.epss_daily, movers_day),
        # documented relations
        "analysis_entries": lambda: rel.analysis_entries(t.archive, t.analysis),
        "analysis_entries_lite": lambda: rel.analysis_entries_lite(t.archive, t.analysis),
        "analysis_entries_campaign": lambda: rel.analysis_entries_campaign(t.archive, t.analysis),
        "analysis_search": lambda: rel.analysis_search(t.archive, t.analysis),
        "analysis_cve_mentions": mentions,
        "analysis_cve_mentions_v2": lambda: rel.cve_mentions_v2(t.archive, t.analysis),
        "analysis_cve_anomalies": lambda: rel.cve_anomalies(t.analysis),
        "analysis_cves_enriched": lambda: rel.cves_enriched(mentions(), t.cve_enriched, t.epss_daily, latest()),
        "analysis_cves_enriched_lite": lambda: rel.cves_enriched_lite(mentions(), t.cve_enriched, t.epss_daily,
                                                                      latest()),
        "cve_detail": lambda: rel.cve_detail(t.cve_enriched, t.epss_daily, mentions(),
                                             rel.campaign_mentions(t.analysis), latest()),
        "nvd_cves_lite": lambda: rel.nvd_cves_lite(t.cve_enriched, t.epss_daily, latest()),
        "kev_cves_lite": lambda: rel.kev_cves_lite(t.cve_enriched),
        "epss_latest": lambda: latest() if latest() is not None else eps.epss_latest(t.epss_daily),
        "epss_top_latest": lambda: rel.epss_top_latest(t.epss_daily, t.cve_enriched, latest()),
        "epss_movers_24h": lambda: eps.movers_24h(t.epss_daily, movers_day),
        "campaign_cve_rollups": rollups,
        "campaign_summary": lambda: rel.campaign_summary(rollups()),
        "campaign_latest_seen": lambda: rel.campaign_latest_seen(rollups()),
        "hourly_sitreps": lambda: rel.hourly_sitreps(t.analysis, as_of),
        "hourly_sitreps_latest": lambda: rel.hourly_sitreps_latest(rel.hourly_sitreps(t.analysis, as_of)),
        "daily_insights_latest": lambda: rel.daily_insights_latest(t.epss_daily),
        "severity_by_source_7d": lambda: rel.severity_by_source(t.analysis, as_of),
        # dashboard helpers with no natural view name in the source system
        "epss_distribution_today": lambda: dsh.epss_distribution(t.epss_daily),
    }


def register_views(spark: SparkSession, tables, as_of, movers_day, names=None) -> list[str]:
    """Create the temp views (all, or only ``names``) and the SQL functions."""
    plans = view_plans(tables, as_of, movers_day)
    chosen = sorted(plans) if names is None else list(names)
    for name in chosen:
        plans[name]().createOrReplaceTempView(name)
    register_sql_functions(spark)
    return chosen
