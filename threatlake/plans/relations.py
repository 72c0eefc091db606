"""The documented read relations over analyses, CVE mentions, campaigns and reports.

All joins are equi-joins on ``cve_id`` / ``archive_id`` / ``campaign_key``; each
aggregation is keyed and partial (map-side combine), and every per-analysis array
(CVE tokens, IOCs, reference URLs) is processed inside its own row before ``explode`` —
no group is ever gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threatlake.functions.iocs import (cve_mentions_in_text, cve_tokens, ioc_elements, valid_cve_tokens,
                                       CVE_TOKEN)
from threatlake.functions.json_fields import description_en, json_array_size, kev_field
from threatlake.functions.scores import campaign_kind, severity_rank
from threatlake.functions.text import search_tokens
from threatlake.functions.urls import pick_campaign_key
from threatlake.operators.snapshots import kev, nvd, ts_lit
from threatlake.plans.epss import epss_latest

PIPELINE_VERSION = "threatlake/1"


# ------------------------------------------------------------------ entries -------
def analysis_entries(archive: DataFrame, analysis: DataFrame) -> DataFrame:
    """Archive items joined to their analyses (full content). The join key is the archive
    row id: a guid alone is not unique (two feeds may carry the same guid / link)."""
    a = archive.select(F.col("id").alias("archive_id"), "title", "link", "published", "content", "author",
                       "categories", "feed_url")
    n = analysis.drop("title")
    return n.join(a, "archive_id").select(
        "analysis_id", "analysis_guid", "archive_id", "archive_guid", "title", "link", "published",
        "content", "author", "categories", "feed_url", "source_name", "severity_level", "confidence_pct",
        "summary_impact", "relevance", "analysed_at", "recommended_actions", "key_iocs",
        "cve_references", "exploit_references")


def analysis_entries_lite(archive: DataFrame, analysis: DataFrame) -> DataFrame:
    """Entries without content, plus severity rank and IOC / CVE / action counts."""
    e = analysis_entries(archive, analysis).drop("content")
    return e.select("*",
                    severity_rank("severity_level").alias("severity_rank"),
                    F.size(ioc_elements("key_iocs")).alias("ioc_count"),
                    json_array_size("cve_references").alias("cve_count"),
                    json_array_size("recommended_actions").alias("action_count"))


def analysis_entries_campaign(archive: DataFrame, analysis: DataFrame) -> DataFrame:
    lite = analysis_entries_lite(archive, analysis)
    return lite.withColumn("campaign_key", pick_campaign_key("exploit_references", "analysis_id"))


def analysis_search(archive: DataFrame, analysis: DataFrame) -> DataFrame:
    """Search fields plus ``document``: distinct lower-case tokens of title, impact
    summary, relevance and content."""
    e = analysis_entries(archive, analysis)
    return e.select("analysis_id", "analysis_guid", "title", "link", "source_name", "severity_level",
                    "confidence_pct", "analysed_at",
                    search_tokens("title", "summary_impact", "relevance", "content").alias("document"))


def search_hits(search: DataFrame, keyword: str, min_confidence: int = 0) -> DataFrame:
    return (search.where(F.array_contains("document", keyword.lower()) & (F.col("confidence_pct") >= min_confidence))
            .select("analysis_id", "title", "source_name", "confidence_pct", "analysed_at",
                    F.size("document").alias("n_tokens"))
            .orderBy(F.col("analysed_at").desc_nulls_first(), F.col("analysis_id").asc()))


def token_frequency(search: DataFrame) -> DataFrame:
    """Inverted-index statistics: per token, the number of analyses whose document holds
    it (common tokens are combined map-side before the shuffle)."""
    t = search.select(F.explode("document").alias("token"))
    return t.groupBy("token").agg(F.count(F.lit(1)).alias("documents"))


TOKEN_BUCKETS = 64
POSTING_PARTS = 4


def _token_bucket(token) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(TOKEN_BUCKETS)).cast("int")


def write_token_index(search: DataFrame, path: str) -> None:
    """The inverted index of ``search``: one posting (token, analysis_id) per row, laid out by
    token bucket and sorted by token, so that a sweep reads the postings of its terms only.
    Buckets are dealt over ``POSTING_PARTS`` tasks each by the analysis, so that a token that most documents hold is
    split; ranges would compute all tokens twice, once for their bounds."""
    # outer: before a plain explode Spark filters by the array's size, which computes the tokens once more
    postings = search.select(F.explode_outer("document").alias("token"), "analysis_id").where("token is not null").withColumn("bucket", _token_bucket("token"))
    part = F.pmod(F.xxhash64("analysis_id"), F.lit(POSTING_PARTS))
    (postings.repartition("bucket", part).sortWithinPartitions("bucket", "token")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def index_sweep(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Per phrase (``phrase``, an AND of its words; without words none match): analyses that hold all its words, by
    intersecting the postings of the words in the stored index. Postings are counted per
    (phrase, analysis), so that no posting list is gathered."""
    words = phrases.select("phrase", F.explode(search_tokens("phrase")).alias("token"))
    sizes = words.groupBy("phrase").agg(F.count("*").alias("words"))
    asked = words.select("token").distinct().withColumn("bucket", _token_bucket("token"))
    buckets = [r.bucket for r in asked.select("bucket").distinct().collect()]  # TOKEN_BUCKETS at most: the partition filter
    tokens = [r.token for r in asked.select("token").limit(1001).collect()]
    read = index.where(F.col("bucket").isin(buckets))
    if len(tokens) <= 1000:  # few enough for a pushed filter, which skips row groups; the join below decides
        read = read.where(F.col("token").isin(tokens))
    held = read.select("token", "analysis_id").join(words, "token").groupBy("phrase", "analysis_id").agg(F.count("*").alias("n"))
    hits = held.join(sizes, "phrase").where(F.col("n") == F.col("words")).groupBy("phrase").agg(F.count("*").alias("analyses"))
    return phrases.select("phrase").distinct().join(hits, "phrase", "left").select("phrase", F.coalesce("analyses", F.lit(0).cast("long")).alias("analyses"))


def keyword_sweep(search: DataFrame, keywords: DataFrame) -> DataFrame:
    """Many-term sweep through the token index: per keyword, matching analyses. The
    keyword list is joined as a relation (AQE broadcasts it when it is small)."""
    kw = keywords.select(F.lower(F.col("keyword")).alias("token")).distinct()
    t = search.select("analysis_id", F.explode("document").alias("token"))
    return (t.join(kw, "token").groupBy("token").agg(F.countDistinct("analysis_id").alias("analyses"))
            .withColumnRenamed("token", "keyword").orderBy("keyword"))


# ------------------------------------------------------------------ mentions ------
def cve_mentions(analysis: DataFrame) -> DataFrame:
    """One row per (analysis, well-formed CVE) from ``cve_references``."""
    return analysis.select("analysis_id", "analysed_at", "source_name",
                           F.explode(valid_cve_tokens("cve_references")).alias("cve_id"))


def cve_mentions_v2(archive: DataFrame, analysis: DataFrame) -> DataFrame:
    """Second extractor: CVE patterns found anywhere in the article (title and full
    content), the impact summary and the raw reference text."""
    e = analysis_entries(archive, analysis)
    return e.select("analysis_id", "analysed_at", "source_name",
                    F.explode(cve_mentions_in_text("title", "content", "summary_impact", "cve_references"))
                    .alias("cve_id"))


CVE_PATTERN = r"(?i)CVE-\d{4}-\d{4,}"


def cve_mentions_in_articles(archive: DataFrame, analysis: DataFrame) -> DataFrame:
    """Mentions extracted from free text only, blind to the analysis' own list: one row per
    CVE pattern in the title or content of the article, with its field and 0-based offset."""
    e = analysis.select("analysis_id", "archive_id").join(archive.select(F.col("id").alias("archive_id"), "title", "content"), "archive_id")
    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("title", "content")]))
    found = (e.select("analysis_id", fields.alias("f")).select("analysis_id", "f.field", "f.text").where(F.col("text").rlike(CVE_PATTERN))
             .withColumn("tokens", F.regexp_extract_all("text", F.lit(CVE_PATTERN), F.lit(0)))
             .withColumn("gaps", F.split("text", CVE_PATTERN, -1)))
    before = lambda part, n: F.length(F.array_join(F.slice(part, F.lit(1), n), ""))
    return (found.select("analysis_id", "field", F.posexplode("tokens").alias("i", "token"), "tokens", "gaps")
            .select("analysis_id", F.upper("token").alias("cve_id"), "field",
                    (before("gaps", F.col("i") + 1) + before("tokens", F.col("i"))).alias("start")))


def mention_drift(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Full outer comparison of two mention extractors on (analysis_id, cve_id)."""
    a = v1.select("analysis_id", "cve_id", F.lit(True).alias("in_v1"))
    b = v2.select("analysis_id", "cve_id", F.lit(True).alias("in_v2"))
    j = a.join(b, ["analysis_id", "cve_id"], "full_outer")
    return j.agg(F.count_if(F.col("in_v1").isNotNull() & F.col("in_v2").isNull()).alias("only_v1"),
                 F.count_if(F.col("in_v1").isNull() & F.col("in_v2").isNotNull()).alias("only_v2"),
                 F.count_if(F.col("in_v1").isNotNull() & F.col("in_v2").isNotNull()).alias("both"))


def cve_anomalies(analysis: DataFrame) -> DataFrame:
    """CVE-like tokens that are not well-formed identifiers, with their mention counts."""
    t = analysis.select(F.explode(cve_tokens("cve_references")).alias("token"))
    return (t.where(~F.col("token").rlike(CVE_TOKEN)).groupBy("token")
            .agg(F.count(F.lit(1)).alias("mentions"))
            .orderBy(F.col("mentions").desc(), F.col("token").asc()))


def mention_stats(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("cve_id").agg(F.count(F.lit(1)).alias("mention_count"),
                                          F.max("analysed_at").alias("last_seen"))


def _latest(epss: DataFrame, latest: DataFrame | None) -> DataFrame:
    """Newest score per CVE: the maintained ``latest`` table when given (the EPSS stream
    keeps it), else aggregated from the daily history."""
    return latest.select("cve_id", "as_of", "epss", "percentile") if latest is not None else epss_latest(epss)


def latest_scores(epss: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    return _latest(epss, latest).select("cve_id", F.col("epss").alias("latest_epss"),
                                    F.col("percentile").alias("latest_percentile"))


def cves_enriched(mentions: DataFrame, cve: DataFrame, epss: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Per mentioned CVE: mention count and last sighting, with the NVD record (EPSS
    overlaid from the newest score per CVE, since the stored column is never filled)."""
    n = nvd(cve).select("cve_id", "source", "cvss_base", "epss", "modified", "json")
    j = mention_stats(mentions).join(n, "cve_id", "left").join(latest_scores(epss, latest), "cve_id", "left")
    return j.select("cve_id", "mention_count", "last_seen", "source", "cvss_base",
                    F.coalesce("epss", "latest_epss").alias("epss"), "modified", "json")


def cves_enriched_lite(mentions: DataFrame, cve: DataFrame, epss: DataFrame,
                       latest: DataFrame | None = None) -> DataFrame:
    e = cves_enriched(mentions, cve, epss, latest)
    return e.select("cve_id", "mention_count", "last_seen", "source", "cvss_base", "epss", "modified",
                    description_en("json").alias("description_en"))


# ---------------------------------------------------------------- CVE views -------
def nvd_cves_lite(cve: DataFrame, epss: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    n = nvd(cve).join(latest_scores(epss, latest), "cve_id", "left")
    return n.select("cve_id", "modified", "cvss_base", F.coalesce("epss", "latest_epss").alias("epss"),
                    description_en("json").alias("description_en"))


def kev_cves_lite(cve: DataFrame) -> DataFrame:
    return kev(cve).select(
        "cve_id",
        kev_field("json", "vendorProject").alias("vendor"),
        kev_field("json", "product").alias("product"),
        kev_field("json", "vulnerabilityName").alias("vulnerability"),
        kev_field("json", "dateAdded").alias("date_added"),
        kev_field("json", "requiredAction").alias("required_action"),
        kev_field("json", "dueDate").alias("due_date"),
        F.col("json").alias("kev_json"))


def epss_top_latest(epss: DataFrame, cve: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Newest score per CVE with the NVD lite fields, highest EPSS first."""
    n = nvd(cve).select("cve_id", "cvss_base", description_en("json").alias("description_en"))
    return (_latest(epss, latest).join(n, "cve_id", "left")
            .select("cve_id", "as_of", "epss", "percentile", "cvss_base", "description_en")
            .orderBy(F.col("epss").desc_nulls_first(), F.col("cve_id").asc()))


# ---------------------------------------------------------------- campaigns -------
def campaign_mentions(analysis: DataFrame) -> DataFrame:
    """CVE mentions tagged with the campaign key of their analysis."""
    a = analysis.select("analysis_id", "archive_id", "analysed_at", "source_name",
                        pick_campaign_key("exploit_references", "analysis_id").alias("campaign_key"),
                        F.explode(valid_cve_tokens("cve_references")).alias("cve_id"))
    return a


def campaign_cve_rollups(analysis: DataFrame, cve: DataFrame, epss: DataFrame,
                         latest: DataFrame | None = None) -> DataFrame:
    """Per (campaign, CVE): mentions, distinct items and sources, first/last sighting,
    with CVSS, EPSS, NVD modification time and English description."""
    g = campaign_mentions(analysis).groupBy("campaign_key", "cve_id").agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.countDistinct("archive_id").alias("item_count"),
        F.countDistinct("source_name").alias("source_count"),
        F.min("analysed_at").alias("first_seen"),
        F.max("analysed_at").alias("last_seen"))
    n = nvd(cve).select("cve_id", "cvss_base", "epss", F.col("modified").alias("cve_modified"),
                        description_en("json").alias("description_en"))
    j = g.join(n, "cve_id", "left").join(latest_scores(epss, latest), "cve_id", "left")
    return j.select("campaign_key", "cve_id", "mention_count", "item_count", "source_count", "first_seen",
                    "last_seen", "cvss_base", F.coalesce("epss", "latest_epss").alias("epss"), "cve_modified",
                    "description_en")


def campaign_summary(rollups: DataFrame) -> DataFrame:
    return rollups.groupBy("campaign_key").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.count(F.lit(1)).alias("distinct_cve_count"), F.max("cvss_base").alias("max_cvss_base"),
        F.max("epss").alias("max_epss"), F.sum("mention_count").alias("item_mentions"))


def campaign_latest_seen(rollups: DataFrame) -> DataFrame:
    s = campaign_summary(rollups)
    return s.select("campaign_key", campaign_kind("distinct_cve_count", "max_epss").alias("campaign_kind"),
                    "first_seen", "last_seen", F.col("distinct_cve_count").alias("cve_count"),
                    "item_mentions", "max_epss", "max_cvss_base")


# ------------------------------------------------------------------ profile -------
def cve_detail(cve: DataFrame, epss: DataFrame, mentions: DataFrame, campaigns: DataFrame,
               latest: DataFrame | None = None) -> DataFrame:
    """Consolidated CVE profile: NVD record ⟕ newest EPSS ⟕ KEV ⟕ mentions ⟕ campaigns.

    ``campaigns`` is any relation with (campaign_key, cve_id) pairs — the campaign
    mentions (cheapest) or the rollups; the profile counts distinct campaigns per CVE."""
    base = nvd(cve).select("cve_id", "cvss_base", "epss", "modified", description_en("json").alias("description_en"))
    k = kev(cve).select("cve_id", F.lit(True).alias("_kev"),
                        kev_field("json", "dueDate").alias("due_date"),
                        kev_field("json", "requiredAction").alias("required_action"))
    camp = campaigns.groupBy("cve_id").agg(F.countDistinct("campaign_key").alias("campaign_count"))
    j = (base.join(latest_scores(epss, latest), "cve_id", "left").join(k, "cve_id", "left")
         .join(mention_stats(mentions), "cve_id", "left").join(camp, "cve_id", "left"))
    return j.select("cve_id", "cvss_base", F.coalesce("epss", "latest_epss").alias("epss"),
                    F.col("latest_percentile").alias("epss_percentile"),
                    F.coalesce("_kev", F.lit(False)).alias("in_kev"), "due_date", "required_action",
                    F.coalesce("mention_count", F.lit(0)).cast("long").alias("mention_count"), "last_seen",
                    F.coalesce("campaign_count", F.lit(0)).cast("long").alias("campaign_count"),
                    "description_en", "modified")


# ------------------------------------------------------------------ reports -------
def hourly_sitreps(analysis: DataFrame, as_of) -> DataFrame:
    """One report per hour of analyses: severity counts and the most mentioned CVE,
    as JSON, keyed by the tumbling window."""
    w = F.window("analysed_at", "1 hour")
    counts = analysis.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("severity_level") == "CRITICAL").alias("critical"),
        F.count_if(F.col("severity_level") == "HIGH").alias("high"),
        F.count_if(F.col("severity_level") == "MEDIUM").alias("medium"),
        F.count_if(F.col("severity_level") == "LOW").alias("low"))
    per_cve = cve_mentions(analysis).groupBy(F.window("analysed_at", "1 hour").alias("w"), "cve_id") \
        .agg(F.count(F.lit(1)).alias("n"))
    top = per_cve.groupBy("w").agg(F.min_by(F.struct("cve_id", "n"), F.struct(-F.col("n"), F.col("cve_id"))).alias("t"))
    j = counts.join(top, "w", "left")
    report = F.to_json(F.struct("items", "critical", "high", "medium", "low",
                                F.col("t.cve_id").alias("top_cve"), F.col("t.n").alias("top_cve_mentions")),
                       {"ignoreNullFields": "false"})
    return j.select(F.concat(F.lit("sitrep-"), F.date_format("w.start", "yyyyMMddHH")).alias("report_id"),
                    F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    ts_lit(as_of).alias("generated_at"), F.lit(PIPELINE_VERSION).alias("pipeline_version"),
                    report.alias("report"))


def hourly_sitreps_latest(sitreps: DataFrame) -> DataFrame:
    return sitreps.orderBy(F.col("window_start").desc()).limit(1)


def daily_insights_latest(epss: DataFrame) -> DataFrame:
    """Latest day's insight document: risk bands, 5-day velocity, growth since the first
    day — one row, each part a scalar subquery over the pruned snapshots."""
    from threatlake.plans.epss import new_cves, velocity
    from threatlake.functions.scores import RISK_BANDS, RISK_BAND_OTHER, epss_risk_band
    from threatlake.operators.snapshots import latest_snapshot
    s = latest_snapshot(epss)
    labels = [lbl for _, lbl in RISK_BANDS] + [RISK_BAND_OTHER]
    band = epss_risk_band("epss")
    v = velocity(epss)
    base = s.agg(F.max("as_of").alias("as_of"), F.count(F.lit(1)).alias("cves"),
                 *[F.count_if(band == lbl).alias(lbl) for lbl in labels])
    doc = F.struct(
        "as_of", "cves", F.struct(*labels).alias("bands"),
        F.struct(*[v.select(c).scalar().alias(c) for c in v.columns]).alias("velocity_5d"),
        new_cves(epss).select("new_cves").scalar().alias("new_since_first"))
    return base.select("as_of", F.to_json(doc).alias("report"))


def severity_by_source(analysis: DataFrame, as_of, days: int = 7) -> DataFrame:
    since = ts_lit(as_of) - F.make_dt_interval(days=F.lit(days))
    return (analysis.where(F.col("analysed_at") >= since)
            .groupBy("source_name", "severity_level").agg(F.count(F.lit(1)).alias("items"))
            .orderBy("source_name", "severity_level"))


def severity_by_source_wide(analysis: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Pivoted form: one column per severity level (listed, so no extra pass to find them)."""
    since = ts_lit(as_of) - F.make_dt_interval(days=F.lit(days))
    levels = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
    p = (analysis.where(F.col("analysed_at") >= since).groupBy("source_name")
         .pivot("severity_level", levels).agg(F.count(F.lit(1))))
    return p.select("source_name", *[F.coalesce(F.col(lv), F.lit(0)).cast("long").alias(lv.lower()) for lv in levels]) \
        .orderBy("source_name")
