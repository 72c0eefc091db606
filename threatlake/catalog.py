"""Registry of named queries over the bindings: name -> callable(spark, sf_dir) -> DataFrame.

Each entry wires the domain operators to the domain tables derived from the driver's
tables (``threatlake.sources.bindings``). ``threatlake.oracle.queries`` holds the DuckDB
SQL with the same name, columns and order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatlake.sources.bindings import AS_OF, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# The same plans as functions of a table set (``bindings.Tables`` or ``layout.StoredTables``).
PLANS: dict[str, Callable] = {}


def register(name: str):
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        PLANS[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- dashboards ------
from threatlake.plans import dashboards as dsh  # noqa: E402

register("dash_total_cves")(lambda t: dsh.total_cves(t.cve_enriched))
register("dash_kev_entries")(lambda t: dsh.kev_entries(t.cve_enriched))
register("dash_critical_cves")(lambda t: dsh.critical_cves(t.cve_enriched))
register("dash_epss_records_latest")(lambda t: dsh.epss_records_latest(t.epss_daily))
register("dash_high_risk_count")(lambda t: dsh.high_risk_count(t.epss_daily, t.cve_enriched))
register("dash_feed_items_7d")(lambda t: dsh.feed_items_window(t.archive, AS_OF))
register("dash_top_exploitable")(lambda t: dsh.top_exploitable(t.epss_daily, t.cve_enriched))
register("dash_movers_latest")(lambda t: dsh.movers_latest(t.epss_daily))
register("dash_epss_distribution")(lambda t: dsh.epss_distribution(t.epss_daily))
register("dash_epss_coverage")(lambda t: dsh.epss_coverage(t.epss_daily))
register("dash_ingest_health")(lambda t: dsh.ingest_health(t.epss_daily, min_rows=10))
register("dash_ingest_log")(lambda t: dsh.ingest_log(t.epss_daily))
register("dash_danger_zone")(lambda t: dsh.danger_zone(t.epss_daily, t.cve_enriched))
register("dash_cvss_distribution")(lambda t: dsh.cvss_distribution(t.cve_enriched))
register("dash_nvd_by_modified_day")(lambda t: dsh.nvd_by_modified_day(t.cve_enriched, AS_OF))
register("dash_latest_critical")(lambda t: dsh.latest_critical(t.cve_enriched, AS_OF))
register("dash_kev_latest")(lambda t: dsh.kev_latest(t.cve_enriched))
register("dash_feed_volume_7d")(lambda t: dsh.feed_volume(t.archive, AS_OF))
register("dash_feed_volume_7d_selected")(
    lambda t: dsh.feed_volume(t.archive, AS_OF, feed_source=["src1%", "src3"]))
register("dash_content_coverage")(lambda t: dsh.content_coverage(t.current))
register("dash_latest_items")(lambda t: dsh.latest_items(t.current))
register("dash_feed_list")(lambda t: dsh.feed_list(t.current))


# --------------------------------------------------------------------- EPSS -------
from threatlake.plans import epss as eps  # noqa: E402

DAY = "2024-01-30"  # stands for CURRENT_DATE in the calendar-day views
register("epss_movers_24h")(lambda t: eps.movers_24h(t.epss_daily, DAY))
register("epss_movers_24h_top50")(lambda t: eps.movers_24h(t.epss_daily, DAY, with_percentiles=False, limit=50))
register("epss_risk_pyramid")(lambda t: eps.risk_pyramid(t.epss_daily))
register("epss_sleepers_between")(
    lambda t: eps.sleepers_between(t.epss_daily, "2024-01-01", "2024-01-30", low=0.10, high=0.50))
register("epss_velocity")(lambda t: eps.velocity(t.epss_daily))
register("epss_universe_growth")(lambda t: eps.universe_growth(t.epss_daily))
register("epss_new_cves")(lambda t: eps.new_cves(t.epss_daily))
register("epss_cwe_exploitability")(lambda t: eps.cwe_exploitability(t.epss_daily, t.cve_enriched))
register("epss_apex")(lambda t: eps.apex(t.epss_daily, t.cve_enriched))


def _epss_with_gaps(t):
    return t.epss_daily.where(~F.col("as_of").isin("2024-01-05", "2024-01-17"))


register("epss_coverage_gaps")(lambda t: eps.coverage_gaps(_epss_with_gaps(t)))
register("epss_coverage_summary")(lambda t: eps.coverage_summary(_epss_with_gaps(t)))
register("feed_cadence_weekly")(lambda t: eps.feed_cadence(t.archive))
register("feed_top_feeds")(lambda t: eps.top_feeds(t.archive))
register("epss_latest_per_cve")(lambda t: eps.epss_latest(t.epss_daily))

# ------------------------------------------------------------------ feed QA -------
from threatlake.plans import feed_qa as qa  # noqa: E402

register("qa_missing_both_per_feed")(lambda t: qa.missing_both_per_feed(t.current))
register("qa_only_content_missing")(lambda t: qa.only_content_missing(t.current))
register("qa_only_summary_missing")(lambda t: qa.only_summary_missing(t.current))
register("qa_missing_both_entries")(lambda t: qa.missing_both_entries(t.current))
register("qa_missing_both_by_day")(lambda t: qa.missing_both_by_day(t.current))
register("qa_feed_coverage_summary")(lambda t: qa.feed_coverage_summary(t.current))
register("qa_most_recent_missing_both")(lambda t: qa.most_recent_missing_both(t.current))
register("qa_missing_both_and_title")(lambda t: qa.missing_both_and_title(t.current))
register("qa_percent_missing_both")(lambda t: qa.percent_missing_both(t.current))
register("qa_most_affected_titles")(lambda t: qa.most_affected_titles(t.current))

# ----------------------------------------------------------------- alerting -------
from threatlake.plans import alerts as alr  # noqa: E402


def _cursor(t, value):
    from threatlake.schemas import INGEST_STATE
    return t.spark.createDataFrame([("ALERTING", value), ("NVD", "2024-01-30T00:00:00Z")], INGEST_STATE)


register("alert_sleepers")(lambda t: alr.detect_sleepers(t.epss_daily, t.cve_enriched))
register("alert_sleepers_lookback3")(lambda t: alr.detect_sleepers(t.epss_daily, t.cve_enriched, lookback=3))
register("alert_once_new_day")(
    lambda t: alr.alert_once(alr.detect_sleepers(t.epss_daily, t.cve_enriched), _cursor(t, "2024-01-29")))
register("alert_once_same_day")(
    lambda t: alr.alert_once(alr.detect_sleepers(t.epss_daily, t.cve_enriched), _cursor(t, "2024-01-30")))
register("alert_next_cursor")(lambda t: alr.next_cursor(alr.detect_sleepers(t.epss_daily, t.cve_enriched)))
register("alert_generic_payload")(
    lambda t: alr.generic_payload(alr.detect_sleepers(t.epss_daily, t.cve_enriched), AS_OF))
register("alert_chat_payload")(lambda t: alr.chat_payload(alr.detect_sleepers(t.epss_daily, t.cve_enriched)))

# ---------------------------------------------------------------- relations -------
from threatlake.operators.query import exact_count, relation_query  # noqa: E402
from threatlake.plans import relations as rel  # noqa: E402
from threatlake.plans import triage as tri  # noqa: E402


def _mentions(t):
    return rel.cve_mentions(t.analysis)


def _rollups(t):
    return rel.campaign_cve_rollups(t.analysis, t.cve_enriched, t.epss_daily)


def _detail(t):
    return rel.cve_detail(t.cve_enriched, t.epss_daily, _mentions(t), rel.campaign_mentions(t.analysis))


def _lite(t):
    return rel.analysis_entries_lite(t.archive, t.analysis)


register("api_analysis_entries")(lambda t: rel.analysis_entries(t.archive, t.analysis))
register("api_analysis_entries_lite")(_lite)
register("api_analysis_entries_campaign")(lambda t: rel.analysis_entries_campaign(t.archive, t.analysis))
register("api_analysis_search")(lambda t: rel.analysis_search(t.archive, t.analysis))
register("api_analysis_search_hits")(
    lambda t: rel.search_hits(rel.analysis_search(t.archive, t.analysis), "and", min_confidence=50))
register("api_cve_mentions")(_mentions)
register("api_cve_mentions_v2")(lambda t: rel.cve_mentions_v2(t.archive, t.analysis))
register("api_cve_mention_drift")(lambda t: rel.mention_drift(_mentions(t), rel.cve_mentions_v2(t.archive, t.analysis)))
register("api_cve_anomalies")(lambda t: rel.cve_anomalies(t.analysis))
register("api_cves_enriched")(lambda t: rel.cves_enriched(_mentions(t), t.cve_enriched, t.epss_daily))
register("api_cves_enriched_lite")(lambda t: rel.cves_enriched_lite(_mentions(t), t.cve_enriched, t.epss_daily))
register("api_cve_detail")(_detail)
register("api_nvd_cves_lite")(lambda t: rel.nvd_cves_lite(t.cve_enriched, t.epss_daily))
register("api_kev_cves_lite")(lambda t: rel.kev_cves_lite(t.cve_enriched))
register("api_epss_top_latest")(lambda t: rel.epss_top_latest(t.epss_daily, t.cve_enriched))
register("api_campaign_cve_rollups")(_rollups)
register("api_campaign_summary")(lambda t: rel.campaign_summary(_rollups(t)))
register("api_campaign_latest_seen")(lambda t: rel.campaign_latest_seen(_rollups(t)))
register("api_hourly_sitreps")(lambda t: rel.hourly_sitreps(t.analysis, AS_OF))
register("api_hourly_sitreps_latest")(lambda t: rel.hourly_sitreps_latest(rel.hourly_sitreps(t.analysis, AS_OF)))
register("api_daily_insights_latest")(lambda t: rel.daily_insights_latest(t.epss_daily))
register("api_severity_by_source_7d")(lambda t: rel.severity_by_source(t.analysis, AS_OF))
register("api_severity_by_source_7d_wide")(lambda t: rel.severity_by_source_wide(t.analysis, AS_OF))

# ------------------------------------------------------------------- triage -------
register("cli_triage")(lambda t: tri.triage(_lite(t), AS_OF, severity=["CRITICAL", "HIGH"], since="7d"))
register("cli_triage_keyword")(lambda t: tri.triage(_lite(t), AS_OF, keyword="le", source="src3", limit=20))
register("cli_cve_get")(lambda t: tri.cve_get(_detail(t), "CVE-2024-00003"))
register("cli_patchlist")(lambda t: tri.patchlist_ranked(t.cve_enriched, t.epss_daily, _mentions(t), AS_OF))
register("cli_patchlist_page")(lambda t: tri.patchlist_ranked(
    t.cve_enriched, t.epss_daily, _mentions(t), AS_OF, cvss_gte=4, mentioned_since="30d", offset=20, limit=30))
register("cli_patchlist_detail")(lambda t: tri.patchlist(_detail(t), AS_OF, cvss_gte=4, offset=20, limit=30,
                                                         mentioned_since="30d"))
register("cli_entries_page")(lambda t: relation_query(
    _lite(t), filters=[("confidence_pct", "gt", 20), ("confidence_pct", "lt", 80), ("severity_level", "neq", "LOW"),
                       ("title", "like", "*le*")],
    order=["confidence_pct.desc", "analysed_at.asc"], tiebreak=["analysis_id"], offset=15, limit=40))
register("cli_patchlist_kev")(lambda t: tri.patchlist_ranked(
    t.cve_enriched, t.epss_daily, _mentions(t), AS_OF, in_kev=True, epss_gte=0.2, mentioned_since="2024-01-01"))
register("cli_campaign_latest")(lambda t: tri.campaign_latest(rel.campaign_latest_seen(_rollups(t))))
register("cli_campaign_latest_story")(
    lambda t: tri.campaign_latest(rel.campaign_latest_seen(_rollups(t)), kind="cve_story", limit=20))


def _busiest_campaign_rollup(t):
    r = _rollups(t)
    busiest = (rel.campaign_summary(r).orderBy(F.col("item_mentions").desc(), F.col("campaign_key").asc())
               .limit(1).select("campaign_key").scalar())
    return tri.campaign_rollup(r, busiest)


register("cli_campaign_rollup")(_busiest_campaign_rollup)
register("cli_ioc")(lambda t: tri.extract_iocs(_lite(t), AS_OF))
register("cli_ioc_contains")(
    lambda t: tri.extract_iocs(_lite(t), AS_OF, severity=["CRITICAL", "MEDIUM"], contains="EXAMPLE", limit=200))


def _rpc(t):
    from threatlake.functions.urls import register_sql_functions
    register_sql_functions(t.spark)
    return t.spark.sql("""
        SELECT analysis_id,
               first_matching_url(exploit_references, 'example\\\\.(com|org)') AS first_url,
               normalise_campaign_url(first_matching_url(exploit_references, '.*')) AS normalised,
               pick_campaign_key(exploit_references, analysis_id) AS campaign_key
        FROM {analysis}""", analysis=t.analysis)


register("rpc_campaign_functions")(_rpc)

# ------------------------------------------------------------ table writes -------
from threatlake.operators import tables as tbl  # noqa: E402
from threatlake.schemas import FEED_ITEM_KEEP_FIRST, INGEST_STATE  # noqa: E402
from threatlake.sources import bindings as bnd  # noqa: E402

ITEM_KEYS, ITEM_ORDER = ["guid", "feed_url"], ["published", "event_id"]


def _split(t):
    v = t.item_versions
    split = F.lit(bnd.B7_SPLIT).cast("timestamp_ntz")
    return v, v.where(F.col("published") < split), v.where(F.col("published") >= split)


def _existing_archive(t):
    _, pre, _ = _split(t)
    return tbl.first_per_key(pre, ITEM_KEYS, ITEM_ORDER)


def _archive_append(t):
    _, _, post = _split(t)
    return tbl.append_new(_existing_archive(t), post, ITEM_KEYS, ITEM_ORDER)


def _current_after(t):
    v, pre, post = _split(t)
    cur0 = tbl.upsert_latest(v.where(F.lit(False)), pre, ITEM_KEYS, ITEM_ORDER, FEED_ITEM_KEEP_FIRST)
    return tbl.upsert_latest(cur0, post, ITEM_KEYS, ITEM_ORDER, FEED_ITEM_KEEP_FIRST)


register("sink_archive_append")(_archive_append)
register("sink_archive_table")(lambda t: _existing_archive(t).unionByName(_archive_append(t)))
register("sink_current_upsert")(_current_after)
register("sink_change_summary")(
    lambda t: tbl.change_summary(tbl.classify_changes(_existing_archive(t), _split(t)[2], ITEM_KEYS, ITEM_ORDER)))
register("sink_epss_new_days")(lambda t: tbl.new_snapshot_rows(
    t.epss_daily.where(F.col("as_of") < "2024-01-20"), t.epss_daily.where(F.col("as_of") >= "2024-01-15")))


def _cve_upsert_nvd(t):
    """Stored: NVD rows modified before 2024-01-15 (EPSS overlaid from the newest score);
    incoming: every NVD row re-published at ``as_of``. SET json / score / modified, keep EPSS."""
    from threatlake.plans.epss import epss_latest
    nvd_all = bnd.nvd_rows(t.raw("part"))
    latest = epss_latest(t.epss_daily).select("cve_id", F.col("epss").alias("_e"))
    ex = (nvd_all.where(F.col("modified") < "2024-01-15").join(latest, "cve_id", "left")
          .withColumn("epss", F.col("_e")).drop("_e"))
    batch = nvd_all.withColumn("modified", bnd.as_of_ts())
    return tbl.upsert_latest(ex, batch, ["cve_id", "source"], ["modified"], keep_first=["epss"])


def _cve_upsert_kev(t):
    """Stored: KEV entries added before 2024-01-15; incoming: the whole catalog re-released
    at ``as_of`` with revised actions. SET json / modified, keep score and EPSS."""
    kev_all = bnd.kev_rows(t.raw("supplier"))
    added = F.get_json_object("json", "$.dateAdded")
    batch = (kev_all.withColumn("modified", bnd.as_of_ts())
             .withColumn("json", F.regexp_replace("json", "Apply updates", "Apply mitigations")))
    return tbl.upsert_latest(kev_all.where(added < "2024-01-15"), batch, ["cve_id", "source"], ["modified"],
                             keep_first=["cvss_base", "epss"])


register("sink_cve_upsert_nvd")(_cve_upsert_nvd)
register("sink_cve_upsert_kev")(_cve_upsert_kev)


def _state(t, kev_cursor="2024-01-28T00:00:00Z"):
    return t.spark.createDataFrame([("NVD", "2024-01-01T00:00:00Z"), ("ALERTING", "2024-01-29"),
                                    ("CISA-KEV", kev_cursor)], INGEST_STATE)


register("sink_cursor_set")(
    lambda t: tbl.set_cursor(_state(t), "EPSS", t.epss_daily.select(F.max("as_of").cast("string")).scalar()))


def _kev_header(t):
    k = t.cve_enriched.where(F.col("source") == "CISA-KEV")
    return k.agg(F.lit("2024.01.28").alias("catalogVersion"),
                 F.date_format(F.max("modified"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("dateReleased"),
                 F.count(F.lit(1)).alias("count"))


register("sink_catalog_gate_unchanged")(lambda t: tbl.catalog_changed(_kev_header(t), _state(t)))
register("sink_catalog_gate_changed")(
    lambda t: tbl.catalog_changed(_kev_header(t), _state(t, kev_cursor="2024-01-01T00:00:00Z")))

# ------------------------------------------------------------------ sources -------
from threatlake.sources import registry as reg  # noqa: E402
from threatlake.sources import validation as val  # noqa: E402
from threatlake.sources import windows as win  # noqa: E402


def _order_span(t):
    o = t.raw("orders")
    start = o.select(F.min("o_orderdate").cast("string")).scalar()
    now = o.select((F.max("o_orderdate") + F.make_dt_interval(days=F.lit(1))).cast("timestamp_ntz")).scalar()
    return o, start, now


register("src_window_plan")(lambda t: win.window_plan(t.spark, *_order_span(t)[1:]))


def _windowed_counts(t):
    o, start, now = _order_span(t)
    return (win.select_windowed(o, "o_orderdate", start, now).groupBy("w_start", "w_end")
            .agg(F.count(F.lit(1)).alias("orders")).orderBy("w_start"))


register("src_windowed_counts")(_windowed_counts)


def _epss_page_stats(t):
    """Page statistics of each day's download: pages ordered by score (page 0 = the top
    quartile by percentile), with the lowest-score page missing on days 7, 14, 21, 28 —
    a short page set that must not count as complete."""
    e = t.epss_daily
    page = F.least(F.floor((F.lit(1.0) - F.col("percentile")) * 4), F.lit(3)).cast("int")
    pages = e.select("as_of", page.alias("page")).where(~((F.dayofmonth("as_of") % 7 == 0) & (F.col("page") == 3)))
    totals = e.groupBy("as_of").agg(F.count(F.lit(1)).alias("total"))
    return pages.groupBy("as_of", "page").agg(F.count(F.lit(1)).alias("rows")).join(totals, "as_of")


register("src_epss_page_completeness")(lambda t: win.page_completeness(_epss_page_stats(t), "as_of"))
register("src_feed_validation_failures")(lambda t: val.validation_failures(val.validate_documents(t.raw_docs)))
register("src_feed_validation_totals")(lambda t: val.validation_totals(val.validate_documents(t.raw_docs)))
register("src_feed_registry_volume")(
    lambda t: reg.volume_by_type_and_tag(t.current, reg.registry_from_items(t.current)))

# --------------------------------------------------------------- row level -------
from threatlake.functions import text as txt  # noqa: E402


def _sanitized_pages(t):
    d = t.raw_docs
    return d.select("url", "status", F.length("body").alias("raw_len"), txt.sanitize_html("body").alias("clean"))


# Fragments that must not get through.
_HOSTILE = """<svg/onload=alert(1)><img src=x/onerror=alert(1)><a href="vbscript:x" title='t"t'>v</a>
<a href=&#106;avascript:alert(1)>e</a><A HREF="https://example.org/?a=1&b=2" onclick="x()">ok</A> 1 < 2
<scr<script></script>ipt>alert(1)</script><iframe src=x>in</iframe><object>"""


def _hostile_pages(t):
    """Pages with hostile markup between two copies of their body."""
    body = F.coalesce("body", F.lit(""))
    return t.raw_docs.select("url", txt.sanitize_html(F.concat(body, F.lit(_HOSTILE), body)).alias("clean"))


def _item_resolution(t):
    d = t.raw("documents")
    did = F.col("doc_id")
    raw = d.select(
        F.col("source").alias("feed_url"),
        F.when(did % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("doc-"), did.cast("string"))).alias("guid"),
        F.when(did % 14 == 0, F.lit("")).otherwise(F.concat(F.lit("https://example.org/"), did.cast("string")))
        .alias("link"),
        F.when(did % 4 == 0, F.lit(None)).otherwise(F.col("text")).alias("description"),
        F.when(did % 6 == 0, F.lit(None)).otherwise(F.col("text")).alias("content"))
    n = raw.select("feed_url", "guid", txt.resolve_guid("guid", "link").alias("key"),
                   txt.content_with_fallback("content", "description").alias("c"),
                   F.coalesce(txt.sanitize_html(F.col("description")), F.lit("")).alias("s"))
    return (n.groupBy("feed_url").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("key").isNull()).alias("rejected"),
        F.count_if((F.col("guid") == "") & F.col("key").isNotNull()).alias("key_from_link"),
        F.count_if(txt.empty_content("c", "s")).alias("empty_content"),
        F.sum(F.length("c")).alias("content_chars"))
        .orderBy("feed_url"))


register("row_sanitized_pages")(_sanitized_pages)
register("row_item_resolution")(_item_resolution)

# ---------------------------------------------------------------------- ops -------
from threatlake.plans import ops  # noqa: E402


def _ops_state(t):
    c, e = t.cve_enriched, t.epss_daily
    fmt = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    nvd_c = c.where(F.col("source") == "NVD").agg(F.date_format(F.max("modified"), fmt).alias("cursor")) \
        .select(F.lit("NVD").alias("source"), "cursor")
    kev_c = c.where(F.col("source") == "CISA-KEV").agg(F.date_format(F.max("modified"), fmt).alias("cursor")) \
        .select(F.lit("CISA-KEV").alias("source"), "cursor")
    eps_c = e.agg(F.max("as_of").cast("string").alias("cursor")).select(F.lit("EPSS").alias("source"), "cursor")
    return nvd_c.unionByName(kev_c).unionByName(eps_c)


register("ops_outcome_rates")(lambda t: ops.outcome_rates(t.fetch_log))
register("ops_outcome_pivot")(lambda t: ops.outcome_pivot(t.fetch_log))
register("ops_cursor_lag")(lambda t: ops.cursor_lag(_ops_state(t), AS_OF))
register("ops_feed_freshness")(lambda t: ops.feed_freshness(t.fetch_log, AS_OF))
register("ops_duration_histogram")(lambda t: ops.duration_histogram(t.fetch_log))
register("ops_hourly_throughput")(lambda t: ops.hourly_throughput(t.fetch_log))
register("ops_alert_rules")(lambda t: ops.alert_rules(t.fetch_log, _ops_state(t), AS_OF))
register("ops_cves_without_cvss")(lambda t: ops.cves_without_cvss(t.cve_enriched))
register("ops_page_size_histogram")(lambda t: ops.page_size_histogram(_epss_page_stats(t)))


def _archive_append_early(t):
    """Append with the batch starting on day 2, so keys first seen in the batch exist."""
    v = t.item_versions
    split = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    pre, post = v.where(F.col("published") < split), v.where(F.col("published") >= split)
    return tbl.append_new(tbl.first_per_key(pre, ITEM_KEYS, ITEM_ORDER), post, ITEM_KEYS, ITEM_ORDER)


register("sink_archive_append_early")(_archive_append_early)

# ---------------------------------------------------------------- streaming -------


def _stream_hourly(t):
    """The update-mode sitrep stream run over the analyses (landed as Parquet in the
    shared scratch folder), read back as a table: equals the batch hourly counts."""
    import uuid

    from threatlake.schemas import ANALYSIS
    from threatlake.session import scratch_path
    from threatlake.streaming import jobs
    run = scratch_path(t.spark, f"stream-hourly-{uuid.uuid4().hex[:12]}")
    t.analysis.write.parquet(f"{run}/landing")
    jobs.sitrep_upsert_stream(t.spark, f"{run}/landing", ANALYSIS, f"{run}/table",
                              name=f"stream-hourly-{uuid.uuid4().hex[:12]}").awaitTermination()
    return t.spark.read.parquet(f"{run}/table").drop("_bucket")


register("stream_hourly_severity")(_stream_hourly)

# ------------------------------------------------------------ extra forms --------
register("dash_epss_distribution_long")(lambda t: dsh.epss_distribution_long(t.epss_daily))
register("cli_triage_count")(
    lambda t: exact_count(_lite(t), [("severity_level", "in", ["CRITICAL", "HIGH"]),
                                     ("analysed_at", "gte", F.lit("2024-01-24 00:00:00").cast("timestamp_ntz"))]))

# ------------------------------------------------------- landed-file scans --------
from threatlake.sources import cve_files as cvf  # noqa: E402
from threatlake.sources import feeds as fds  # noqa: E402
from threatlake.sources import landing as lnd  # noqa: E402


def _scratch(t, name):
    import uuid

    from threatlake.session import scratch_path
    return scratch_path(t.spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _cve_num(col="cve_id"):
    return F.substr(col, F.lit(10)).cast("long")


def _nvd_roundtrip(t):
    p = _scratch(t, "nvd-landing")
    lnd.write_nvd_pages(t.cve_enriched, p, _cve_num())
    return cvf.read_nvd_pages(t.spark, p, AS_OF, multi_line=False)


def _kev_roundtrip(t):
    p = _scratch(t, "kev-landing")
    lnd.write_kev_catalogs(t.cve_enriched, p, _cve_num(), "2024-01-28T00:00:00Z")
    _, rows = cvf.read_kev_catalog(t.spark, p, AS_OF, multi_line=False)
    return rows


def _epss_roundtrip(t):
    from threatlake.schemas import EPSS_PAGE
    p = _scratch(t, "epss-landing")
    lnd.write_epss_pages(t.epss_daily, p, _cve_num())
    pages = (t.spark.read.schema(EPSS_PAGE).json(p).withColumn("_file", F.col("_metadata.file_path"))
             .withColumn("snapshot", cvf.snapshot_key()))
    return cvf.epss_rows(pages, "snapshot")


def _feed_roundtrip(t):
    p = _scratch(t, "feed-landing")
    lnd.write_feed_xml(t.current, p)
    raw = fds.read_feed_items(t.spark, f"{p}/*/*.xml", kind="atom")
    items = fds.normalise_items(raw, F.regexp_replace(fds.feed_key_from_path(), "^feed_url=", ""), AS_OF)
    return items.select("guid", "title", "link", "feed_url", "published", "content", "summary", "categories",
                        "_valid", "_empty")


def _landed_feed():
    """The feed of a document in ``feed=<feed>--<page>/``."""
    return F.regexp_extract("_file", r"/feed=([^/]*?)--[^/]*/[^/]+$", 1)


def _feed_kinds(t):
    """Feeds of three kinds, some documents cut off, some items without a key, and web pages
    in one landing folder through the feed stream: its run log, rejects and archive per feed."""
    from threatlake.streaming import jobs
    p = _scratch(t, "mixed-landing")
    number = F.substr("guid", F.lit(5)).cast("long")
    keyless = number % 45 == 0
    items = t.current.withColumn("page", F.floor(number / 200)).withColumns(
        {"link": F.when(~keyless, F.col("link")), "guid": F.when(~keyless, F.col("guid"))})
    last = F.ascii(F.right("feed_url", F.lit(1))) % 3
    lnd.write_feed_documents(items, f"{p}/landing", F.when(last == 0, "rss").when(last == 1, "rdf").otherwise("atom"),
                             F.col("page"), F.col("page") % 5 == 4)
    web = t.raw("pages").groupBy(F.floor(F.col("page_id") / 200).alias("n")).agg(F.concat_ws("", F.collect_list("html")).alias("value"))
    lnd.write_documents(web.select(F.concat(F.lit("web--"), F.when(F.col("n").isNotNull(), "all")).alias("feed"), "value"), f"{p}/landing")
    jobs.feed_ingest(t.spark, f"{p}/landing/*/", f"{p}/archive", f"{p}/current", now=AS_OF, name=p.rsplit("/", 1)[-1], feed=_landed_feed(),
                     log_path=f"{p}/log", rejects_path=f"{p}/rejects", max_files=10000).awaitTermination()
    sums = ["documents", "rejected", "items", "new", "updated", "failed", "empty_content"]
    log = t.spark.read.parquet(f"{p}/log").groupBy("feed_name").agg(*[F.sum(c).alias(c) for c in sums])
    refused = t.spark.read.parquet(f"{p}/rejects").groupBy("feed_name").agg(
        F.max("kind").alias("cut_kind"), F.count_if(F.col("reason") == "malformed").alias("malformed"),
        F.count_if(F.col("reason") == "unknown root").alias("unknown_root"))
    stored = t.spark.read.parquet(f"{p}/archive").groupBy(F.col("feed_url").alias("feed_name")).agg(F.count("*").alias("archived"))
    return (log.join(refused, "feed_name", "left").join(stored, "feed_name", "left")
            .na.fill(0, ["malformed", "unknown_root", "archived"])
            .select("feed_name", *sums, "cut_kind", "malformed", "unknown_root", "archived"))


def _run_log_changes(t):
    """Item versions landed before and after the split, through the feed stream twice: the
    changes per feed that the second run entered in its log."""
    from threatlake.streaming import jobs
    p = _scratch(t, "versions")
    _, pre, post = _split(t)
    for run, rows in (("first", pre), ("second", post)):
        lnd.write_feed_documents(rows, f"{p}/{run}", F.lit("rss"), F.floor(F.col("event_id") / 500))
        jobs.feed_ingest(t.spark, f"{p}/{run}/*/", f"{p}/archive", f"{p}/current", now=AS_OF, name=f"{p.rsplit('/', 1)[-1]}-{run}",
                         feed=_landed_feed(), log_path=f"{p}/log", max_files=10000).awaitTermination()
    log = t.spark.read.parquet(f"{p}/log").where(F.col("job").endswith("-second"))
    return log.groupBy(F.col("feed_name").alias("feed_url")).agg(
        F.sum("items").alias("processed"), *[F.sum(c).alias(c) for c in ("new", "updated", "failed", "empty_content")])


def _nvd_windows(t):
    """Orders as NVD records through the windowed run, broken off after its second window and
    run again: stored records per window, and the window after which the cursor log stood then."""
    from threatlake.functions.json_fields import cve_published
    from threatlake.operators.cursors import read_cursors
    from threatlake.operators.cursors import append_cursor
    from threatlake.streaming import jobs
    p = _scratch(t, "nvd-windows")
    o, start, now = _order_span(t)
    begin, end = t.spark.range(1).select(start, now.cast("string")).first()
    number = F.col("o_orderkey").cast("string")
    rows = o.select(F.concat(F.lit("CVE-2024-"), F.lpad(number, 9, "0")).alias("cve_id"), F.lit("NVD").alias("source"),
                    F.to_json(F.struct(F.concat(F.lit("CVE-2024-"), F.lpad(number, 9, "0")).alias("id"),
                                       F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("published"))).alias("json"),
                    F.col("o_orderdate").cast("timestamp_ntz").alias("modified"))
    lnd.write_nvd_pages(rows, f"{p}/landing", _cve_num())
    append_cursor(t.spark, f"{p}/state", "NVD", begin)
    run = lambda **more: jobs.nvd_window_ingest(t.spark, f"{p}/landing", f"{p}/cve", f"{p}/state", end, days=800, multi_line=False, **more)
    run(max_windows=2)
    stood = read_cursors(t.spark, f"{p}/state").first().cursor
    run()
    stored = t.spark.read.parquet(f"{p}/cve").withColumn("published", cve_published("json"))
    return (win.select_windowed(stored, "published", begin, end, 800).groupBy("w_start", "w_end")
            .agg(F.count("*").alias("records"))
            .withColumn("before_break", F.col("w_end") <= F.try_to_timestamp(F.lit(stood)).cast("timestamp_ntz")))


# Phrases of the sweep, each an AND of its words.
_PHRASES = ["the", "and the", "de la", "und der", "with ation", "The THE", "nowhere-to-be-found the", ""]


def _index_sweep(t):
    p = _scratch(t, "token-index")
    rel.write_token_index(rel.analysis_search(t.archive, t.analysis), p)
    return rel.index_sweep(t.spark.read.parquet(p), t.spark.createDataFrame([(x,) for x in _PHRASES], "phrase string"))


def _planted(t):
    """The archive with CVE ids planted in texts: of some articles the id their analysis lists, of
    others one that it does not list, some twice."""
    number = F.substr("guid", F.lit(5)).cast("long")
    listed = t.analysis.select(F.col("archive_id").alias("id"), F.array_min(rel.valid_cve_tokens("cve_references")).alias("_cve"))
    other = F.concat(F.lit("cve-2023-"), F.lpad(number.cast("string"), 7, "0"))
    extra = F.concat(F.when((number % 3 == 0) & F.col("_cve").isNotNull(), F.concat(F.lit(" (see "), "_cve", F.lit(")."))).otherwise(""),
                     F.when(number % 5 == 0, F.concat(F.lit("\n"), other, F.lit(": patch; "), other)).otherwise(""))
    return (t.archive.join(listed, "id", "left").withColumn("content", F.concat(F.coalesce("content", F.lit("")), extra))
            .withColumn("title", F.when(number % 15 == 0, F.concat(other, F.lit(" "), "title")).otherwise(F.col("title"))).drop("_cve"))


def _text_mentions(t):
    return rel.cve_mentions_in_articles(_planted(t), t.analysis)


register("api_search_index_sweep")(_index_sweep)
register("api_cve_mentions_text")(_text_mentions)
register("api_cve_mention_drift_text")(lambda t: rel.mention_drift(
    _mentions(t), _text_mentions(t).select("analysis_id", "cve_id").distinct()))
register("alert_generic_payload_rows")(lambda t: alr.read_generic_payload(
    alr.generic_payload(alr.detect_sleepers(t.epss_daily, t.cve_enriched), AS_OF)))
register("alert_chat_payload_blocks")(lambda t: alr.read_chat_payload(
    alr.chat_payload(alr.detect_sleepers(t.epss_daily, t.cve_enriched, lookback=3), max_sections=3)))
register("stream_feed_kinds")(_feed_kinds)
register("stream_run_log_changes")(_run_log_changes)
register("stream_nvd_windows")(_nvd_windows)
register("src_nvd_pages_roundtrip")(_nvd_roundtrip)
register("src_kev_catalog_roundtrip")(_kev_roundtrip)
register("src_epss_pages_roundtrip")(_epss_roundtrip)
register("src_feed_xml_roundtrip")(_feed_roundtrip)
register("api_search_token_frequency")(lambda t: rel.token_frequency(rel.analysis_search(t.archive, t.analysis)))
register("feed_cadence_by_month")(lambda t: eps.feed_cadence_by_month(t.archive))


# ---------------------------------------------------------------- SQL views -------
def _sql(t, text, views):
    """Run SQL over the named views; ``{name}`` placeholders bind per-call views, so
    concurrent queries never see each other's plans."""
    from threatlake.functions.urls import register_sql_functions
    from threatlake.plans.views import view_plans
    plans = view_plans(t, AS_OF, DAY)
    register_sql_functions(t.spark)
    return t.spark.sql(text, **{v: plans[v]() for v in views})


register("sql_patchlist_in_kev")(lambda t: _sql(t, """
    SELECT cve_id, epss, cvss_base, due_date, required_action FROM {cve_detail}
    WHERE in_kev AND epss >= 0.2 ORDER BY epss DESC NULLS FIRST, cvss_base DESC NULLS FIRST, cve_id LIMIT 50""",
    ["cve_detail"]))
register("sql_feed_quality_join")(lambda t: _sql(t, """
    SELECT s.feed_url, s.total, s.percent_both_missing, m.missing_both, r.most_recent_missing
    FROM {v_feed_coverage_summary} s
    LEFT JOIN {v_missing_both_per_feed} m ON m.feed_url = s.feed_url
    LEFT JOIN {v_most_recent_missing_both} r ON r.feed_url = s.feed_url""",
    ["v_feed_coverage_summary", "v_missing_both_per_feed", "v_most_recent_missing_both"]))
register("sql_campaign_kinds")(lambda t: _sql(t, """
    SELECT campaign_kind, count(*) AS campaigns, sum(item_mentions) AS mentions, max(max_epss) AS max_epss
    FROM {campaign_latest_seen} GROUP BY campaign_kind""", ["campaign_latest_seen"]))
register("sql_known_exploited_by_cvss")(lambda t: _sql(t, """
    SELECT CAST(floor(n.cvss_base) AS INT) AS cvss_floor, count(*) AS cves, count(k.cve_id) AS known_exploited
    FROM {cve_enriched} n LEFT JOIN (SELECT DISTINCT cve_id FROM {cve_enriched} WHERE source = 'CISA-KEV') k
      ON k.cve_id = n.cve_id
    WHERE n.source = 'NVD' GROUP BY 1""", ["cve_enriched"]))
register("alert_section_parts")(lambda t: alr.section_parts(alr.detect_sleepers(t.epss_daily, t.cve_enriched)))
register("alert_section_parts_lookback3")(
    lambda t: alr.section_parts(alr.detect_sleepers(t.epss_daily, t.cve_enriched, lookback=3)))
register("row_strict_sanitized_pages")(_hostile_pages)


def _epss_sparse(t):
    """The snapshot table with a short page set on 2024-01-23: the download stopped before
    the low-score tail (scores under 0.05 missing that day), so global-day and per-CVE
    baselines differ."""
    e = t.epss_daily
    return e.where(~((F.col("as_of") == F.lit("2024-01-23").cast("date")) & (F.col("epss") < F.lit(0.05))))


register("alert_sleepers_asof_per_cve")(
    lambda t: alr.detect_sleepers(_epss_sparse(t), t.cve_enriched, per_cve_baseline=True))
register("alert_sleepers_sparse_global_day")(lambda t: alr.detect_sleepers(_epss_sparse(t), t.cve_enriched))
register("dash_movers_latest_fallers")(lambda t: dsh.movers_latest(t.epss_daily, direction="down"))
register("epss_movers_24h_abs_top50")(
    lambda t: eps.movers_24h(t.epss_daily, DAY, with_percentiles=False, limit=50, direction="abs"))
register("sink_kev_removed_since_release")(lambda t: tbl.removed_from_catalog(
    t.cve_enriched, t.cve_enriched.where((F.col("source") == "CISA-KEV")
                                         & (F.get_json_object("json", "$.dateAdded") < "2024-01-20"))))

# ---------------------------------------------------------- materialized ---------
from threatlake.plans import materialized as mv  # noqa: E402


def _materialized(name):
    def run(t):
        root = _scratch(t, "materialized")
        mv.refresh(t.spark, t, root, [name])
        return mv.read(t.spark, root, name)
    return run


for _name in sorted(mv.MATERIALIZED):
    register(f"mv_{_name}")(_materialized(_name))
register("cli_campaign_latest_active")(
    lambda t: tri.campaign_latest(rel.campaign_latest_seen(_rollups(t)), kind="active_exploitation", limit=20))
