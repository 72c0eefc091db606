"""Score buckets, bands, risk arithmetic and alert line formatting (JVM-side Columns)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threatlake.functions.common import col_of


# CVSS histogram labels with their upper edges (exclusive), lowest first.
CVSS_BUCKETS = [(1, "0-1 (None)"), (4, "1-4 (Low)"), (7, "4-7 (Medium)"), (9, "7-9 (High)")]
CVSS_BUCKET_TOP = "9-10 (Critical)"


def cvss_bucket(cvss) -> Column:
    """Dashboard CVSS histogram label (left-closed edges 1, 4, 7, 9)."""
    c = col_of(cvss)
    expr = None
    for edge, label in CVSS_BUCKETS:
        expr = F.when(c < edge, label) if expr is None else expr.when(c < edge, label)
    return expr.otherwise(CVSS_BUCKET_TOP)


# EPSS histogram edges and labels of the dashboard distribution panel.
EPSS_BUCKETS = [
    ("0-1%", None, 0.01), ("1-5%", 0.01, 0.05), ("5-10%", 0.05, 0.1), ("10-30%", 0.1, 0.3),
    ("30-50%", 0.3, 0.5), ("50-70%", 0.5, 0.7), ("70-90%", 0.7, 0.9), ("90-100%", 0.9, None),
]


def epss_bucket_predicate(epss, lo, hi) -> Column:
    c = col_of(epss)
    p = F.lit(True)
    if lo is not None:
        p = p & (c >= F.lit(lo))
    if hi is not None:
        p = p & (c < F.lit(hi))
    return p


def epss_bucket(epss) -> Column:
    """Long-form label of the 8-bucket EPSS histogram."""
    c = col_of(epss)
    expr = None
    for label, lo, hi in EPSS_BUCKETS:
        if hi is None:
            return expr.otherwise(label)
        expr = F.when(c < F.lit(hi), label) if expr is None else expr.when(c < F.lit(hi), label)
    return expr


# EPSS risk bands (lower edge, label), highest first.
RISK_BANDS = [(0.5, "Critical"), (0.1, "High"), (0.01, "Medium"), (0.001, "Low")]
RISK_BAND_OTHER = "Negligible"


def epss_risk_band(epss) -> Column:
    c = col_of(epss)
    expr = None
    for edge, label in RISK_BANDS:
        expr = F.when(c >= F.lit(edge), label) if expr is None else expr.when(c >= F.lit(edge), label)
    return expr.otherwise(RISK_BAND_OTHER)


def risk_score(cvss, epss) -> Column:
    """``round(cvss * epss * 10 / 10, 2)`` on exact decimals (HALF_UP like NUMERIC)."""
    return F.round(col_of(cvss) * col_of(epss), 2)


def pct_change(before, now) -> Column:
    """Relative change in percent; 0 when the baseline is not positive."""
    b, n = col_of(before), col_of(now)
    return F.when(b > 0, (n - b) / b * 100).otherwise(F.lit(0.0))


def day_gap(date_a, date_b) -> Column:
    """Whole days from ``date_a`` to ``date_b`` (yyyy-MM-dd text); unparseable -> 0."""
    a = F.try_to_timestamp(col_of(date_a), F.lit("yyyy-MM-dd"))
    b = F.try_to_timestamp(col_of(date_b), F.lit("yyyy-MM-dd"))
    return F.coalesce(F.datediff(b, a), F.lit(0))


def in_flag(matched_key) -> Column:
    """1 when an outer-join partner exists, else 0."""
    return F.when(col_of(matched_key).isNotNull(), 1).otherwise(0)


# Chat badge of a CVSS score — band edges (highest first) with their
# emoji, the n/a text, the two badge formats; the EPSS trajectory line of an alert.
CVSS_BADGE_BANDS = [(9.0, ":red_circle:"), (7.0, ":large_orange_circle:"), (4.0, ":large_yellow_circle:")]
CVSS_BADGE_LOWEST = ":large_green_circle:"
CVSS_BADGE_NA = "CVSS: _n/a_"
CVSS_BADGE_WITH_SEVERITY = "%s CVSS *%.1f* (%s)"
CVSS_BADGE_PLAIN = "%s CVSS *%.1f*"
EPSS_ALERT_LINE = "EPSS: %.2f%% :arrow_right: *%.2f%%*  (+%.0f%%)  |  Percentile: *%.0f*"


def cvss_badge(score, severity) -> Column:
    """Chat badge: coloured circle by band plus ``CVSS *x.y* (SEV)``; n/a for NULL."""
    s = col_of(score).cast("double")
    sev = F.coalesce(col_of(severity), F.lit(""))
    emoji = None
    for edge, icon in CVSS_BADGE_BANDS:
        emoji = F.when(s >= edge, icon) if emoji is None else emoji.when(s >= edge, icon)
    emoji = emoji.otherwise(CVSS_BADGE_LOWEST)
    body = F.when(sev != "", F.format_string(CVSS_BADGE_WITH_SEVERITY, emoji, s, sev)) \
            .otherwise(F.format_string(CVSS_BADGE_PLAIN, emoji, s))
    return F.when(s.isNull(), F.lit(CVSS_BADGE_NA)).otherwise(body)


# CWE identifiers that carry no information.
CWE_PLACEHOLDERS = ["", "NVD-CWE-noinfo", "NVD-CWE-Other"]


def cwe_display(cwe) -> Column:
    c = F.coalesce(col_of(cwe), F.lit(""))
    return F.when(c.isin(CWE_PLACEHOLDERS), F.lit("")).otherwise(F.concat(F.lit(" | "), c))


def epss_alert_line(epss_before, epss_now, pct, percentile) -> Column:
    return F.format_string(
        EPSS_ALERT_LINE,
        col_of(epss_before).cast("double") * 100, col_of(epss_now).cast("double") * 100,
        col_of(pct).cast("double"), F.coalesce(col_of(percentile).cast("double"), F.lit(0.0)) * 100)


# Severity order of analyses (ours: the source system documents the column, not values).
SEVERITY_RANKS = [("CRITICAL", 4), ("HIGH", 3), ("MEDIUM", 2), ("LOW", 1)]


def severity_rank(level) -> Column:
    """CRITICAL 4, HIGH 3, MEDIUM 2, LOW 1, other 0 (case-insensitive)."""
    u = F.upper(F.trim(col_of(level)))
    expr = None
    for name, rank in SEVERITY_RANKS:
        expr = F.when(u == name, rank) if expr is None else expr.when(u == name, rank)
    return expr.otherwise(0)


# Campaign classes with their thresholds, checked in this order.
CAMPAIGN_PATCH_WAVE_CVES = 10
CAMPAIGN_ACTIVE_MAX_EPSS = 0.2
CAMPAIGN_KINDS = ["patch_wave", "active_exploitation", "cve_story"]


def campaign_kind(distinct_cves, max_epss) -> Column:
    """patch_wave (>= 10 CVEs), then active_exploitation (max EPSS >= 0.2), else cve_story."""
    wave, active, story = CAMPAIGN_KINDS
    return (F.when(col_of(distinct_cves) >= CAMPAIGN_PATCH_WAVE_CVES, wave)
            .when(col_of(max_epss) >= F.lit(CAMPAIGN_ACTIVE_MAX_EPSS), active)
            .otherwise(story))
