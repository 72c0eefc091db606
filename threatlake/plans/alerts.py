"""Sleeper-CVE detection, once-per-day gating and alert payloads.

Detection reads two snapshots only (latest and the as-of baseline), both chosen by
scalar subqueries over ``as_of``; CVE look-ups are decorrelated into one keyed pick per
CVE (NVD row first) aggregated with ``min_by`` — partial aggregation, no per-CVE sort.
Payload building collects only the alert rows, whose number the detection caps
(``limit``, 50 by default) — the cap is the feature, not a sampling shortcut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threatlake.functions.json_fields import cve_cwe, cve_description, cve_severity
from threatlake.functions.scores import cvss_badge, cwe_display, day_gap, epss_alert_line, pct_change
from threatlake.operators.snapshots import latest_date, ts_lit

DEFAULT_LOOKBACK = 7

# Alert texts — header, baseline context (with our product name in the
# source system's place), NVD detail link, overflow note, generic event name, the
# number of sections per message and the description length limit.
ALERT_HEADER = "Sleeper CVE Alert — %d CVEs crossed 50%% EPSS"
ALERT_CONTEXT = "Baseline *%s* vs *%s* (%d-day lookback) | %s"
NVD_DETAIL_URL = "https://nvd.nist.gov/vuln/detail/"
ALERT_MORE = "_...and %d more. Query the %s tables for the full list._"
ALERT_EVENT = "sleeper_cve_alert"
MAX_SECTIONS = 10
MAX_DESCRIPTION_CHARS = 200


def cve_pick(cve: DataFrame) -> DataFrame:
    """One row per CVE for enrichment: the NVD row when present, else any other source
    (lowest source name, for determinism)."""
    prio = F.struct(F.when(F.col("source") == "NVD", 0).otherwise(1), F.col("source"))
    g = cve.groupBy("cve_id").agg(F.min_by(F.struct("json", "cvss_base"), prio).alias("p"))
    return g.select("cve_id", F.col("p.json").alias("json"), F.col("p.cvss_base").alias("cvss_base"))


def detect_sleepers(epss: DataFrame, cve: DataFrame, lookback: int = DEFAULT_LOOKBACK,
                    low: float = 0.10, high: float = 0.50, limit: int = 50,
                    per_cve_baseline: bool = False) -> DataFrame:
    """CVEs under ``low`` on the baseline day (latest day with as_of <= latest - lookback)
    and at or over ``high`` on the latest day; largest rise first.

    ``per_cve_baseline``: as-of join instead — each CVE's baseline is its own newest score
    on or before the cutoff (``max_by`` keyed by CVE over the days up to the cutoff), so a
    CVE missing on the global baseline day still gets compared."""
    if lookback <= 0:
        lookback = DEFAULT_LOOKBACK
    latest = latest_date(epss)
    cutoff = F.date_sub(latest, lookback)
    now = epss.where(F.col("as_of") == latest).select(
        "cve_id", F.col("epss").cast("double").alias("epss_now"),
        F.col("percentile").cast("double").alias("percentile"))
    if per_cve_baseline:
        b = epss.where(F.col("as_of") <= cutoff).groupBy("cve_id").agg(
            F.max_by(F.struct("as_of", "epss"), "as_of").alias("b"))
        before = b.select("cve_id", F.col("b.epss").cast("double").alias("epss_before"),
                          F.col("b.as_of").cast("string").alias("date_before"))
        baseline_text = F.col("date_before")
    else:
        baseline = epss.where(F.col("as_of") <= cutoff).select(F.max("as_of")).scalar()
        before = epss.where(F.col("as_of") == baseline).select(
            "cve_id", F.col("epss").cast("double").alias("epss_before"))
        baseline_text = baseline.cast("string")
    hits = now.join(before, "cve_id").where((F.col("epss_before") < low) & (F.col("epss_now") >= high))
    delta = F.col("epss_now") - F.col("epss_before")
    order = [F.col("delta").desc(), F.col("cve_id").asc()]
    # Rank first, enrich after: the look-up aggregation then only sees the <= limit
    # winning CVEs (their keys reach it through a broadcast semi-join).
    top = hits.withColumn("delta", delta).orderBy(*order).limit(limit)
    p = cve_pick(cve.join(top.select("cve_id"), "cve_id", "left_semi"))
    return (top.join(p, "cve_id", "left")
            .select("cve_id", "epss_before", "epss_now", "delta",
                    pct_change("epss_before", "epss_now").alias("pct_change"),
                    "percentile",
                    baseline_text.alias("date_before"),
                    latest.cast("string").alias("date_now"),
                    F.coalesce(cve_description("json"), F.lit("")).alias("description"),
                    F.col("cvss_base").cast("double").alias("cvss_score"),
                    cve_severity("json").alias("cvss_severity"),
                    cve_cwe("json").alias("cwe"))
            .orderBy(*order))


def alert_once(sleepers: DataFrame, cursors: DataFrame, source: str = "ALERTING") -> DataFrame:
    """Rows to deliver: only when the detection day differs from the stored cursor."""
    cur = cursors.where(F.col("source") == source).select(F.col("cursor").alias("_sent"))
    return sleepers.join(cur, sleepers["date_now"] == cur["_sent"], "left_anti")


def next_cursor(sleepers: DataFrame, source: str = "ALERTING") -> DataFrame:
    """The cursor row to store after an alert run (advanced even when delivery failed)."""
    return sleepers.agg(F.max("date_now").alias("cursor")).where(F.col("cursor").isNotNull()) \
        .select(F.lit(source).alias("source"), "cursor")


# ----------------------------------------------------------------- payloads -------
_SLEEPER_FIELDS = ["cve_id", "epss_before", "epss_now", "delta", "pct_change", "percentile",
                   "date_before", "date_now", "description", "cvss_score", "cvss_severity", "cwe"]


def generic_payload(sleepers: DataFrame, as_of) -> DataFrame:
    """One row, one JSON document ``{event, timestamp, count, sleepers[]}``; NULL scores
    are kept as ``null``."""
    items = F.sort_array(F.collect_list(F.struct(
        (-F.col("delta")).alias("_k"), F.col("cve_id").alias("_k2"),
        F.struct(*_SLEEPER_FIELDS).alias("v"))))
    doc = F.struct(
        F.lit(ALERT_EVENT).alias("event"),
        F.date_format(ts_lit(as_of), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.count(F.lit(1)).cast("int").alias("count"),
        F.transform(items, lambda x: x["v"]).alias("sleepers"))
    return sleepers.agg(F.to_json(doc, {"ignoreNullFields": "false"}).alias("payload"))


_GENERIC = ("event string, timestamp string, count int, sleepers array<struct<cve_id:string,epss_before:double,epss_now:double,"
            "delta:double,pct_change:double,percentile:double,date_before:string,date_now:string,description:string,"
            "cvss_score:double,cvss_severity:string,cwe:string>>")


def read_generic_payload(payloads: DataFrame) -> DataFrame:
    """The typed columns of ``generic_payload`` documents: one row per sleeper, with the event's
    own fields and the sleeper's place in the list."""
    doc = payloads.select(F.from_json("payload", _GENERIC).alias("d")).select("d.*")
    return (doc.select("event", "timestamp", "count", F.posexplode("sleepers").alias("place", "s"))
            .select("event", "timestamp", "count", "place", "s.*"))


def read_chat_payload(payloads: DataFrame) -> DataFrame:
    """One row per block of ``chat_payload`` documents, in order: its type, and the type and text of what it shows."""
    block = "struct<type:string,text:struct<type:string,text:string>,elements:array<struct<type:string,text:string>>>"
    doc = payloads.select(F.from_json("payload", f"blocks array<{block}>").alias("d"))
    shown = F.coalesce(F.col("b.text"), F.get("b.elements", F.lit(0)))
    return (doc.select(F.posexplode("d.blocks").alias("place", "b"))
            .select("place", F.col("b.type").alias("type"), shown["type"].alias("text_type"), shown["text"].alias("text")))


def _truncate(text: Column, n: int = MAX_DESCRIPTION_CHARS) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substr(text, F.lit(1), F.lit(n - 3)), F.lit("..."))) \
        .otherwise(text)


def section_parts(sleepers: DataFrame) -> DataFrame:
    """The engine-independent pieces of each chat section: CVSS badge, CWE suffix, the
    description cut to the message limit, and the baseline-to-now day gap."""
    return sleepers.select(
        "cve_id", cvss_badge("cvss_score", "cvss_severity").alias("badge"), cwe_display("cwe").alias("cwe_suffix"),
        _truncate(F.coalesce(F.col("description"), F.lit(""))).alias("description_short"),
        day_gap("date_before", "date_now").alias("day_gap"))


def section_text(s: DataFrame) -> Column:
    """Three-line chat section of one sleeper row."""
    link = F.concat(F.lit(NVD_DETAIL_URL), F.col("cve_id"))
    line1 = F.concat(F.lit("*<"), link, F.lit("|"), F.col("cve_id"), F.lit(">*  "),
                     cvss_badge("cvss_score", "cvss_severity"), cwe_display("cwe"))
    line2 = epss_alert_line("epss_before", "epss_now", "pct_change", "percentile")
    desc = _truncate(F.coalesce(F.col("description"), F.lit("")))
    line3 = F.when(desc != "", F.concat(F.lit("\n>"), desc)).otherwise(F.lit(""))
    return F.concat(line1, F.lit("\n"), line2, line3)


def chat_payload(sleepers: DataFrame, max_sections: int = MAX_SECTIONS, product: str = "threatlake") -> DataFrame:
    """Block-kit style JSON: header with the count, context with both dates and the day
    gap, one section + divider per sleeper (at most ``max_sections``, largest rise first)
    and an "…and N more" context when there are more. No row when there are no sleepers."""
    rows = sleepers.select(
        (-F.col("delta")).alias("_k"), F.col("cve_id").alias("_k2"),
        F.col("date_before"), F.col("date_now"), section_text(sleepers).alias("text"))
    g = rows.agg(F.sort_array(F.collect_list(F.struct("_k", "_k2", "date_before", "date_now", "text"))).alias("xs"),
                 F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
    first = F.get(F.col("xs"), 0)
    block = lambda typ, text_type, text: F.struct(
        F.lit(typ).alias("type"),
        F.struct(F.lit(text_type).alias("type"), text.alias("text")).alias("text"),
        F.lit(None).cast("array<struct<type:string,text:string>>").alias("elements"))
    ctx = lambda text: F.struct(
        F.lit("context").alias("type"),
        F.lit(None).cast("struct<type:string,text:string>").alias("text"),
        F.array(F.struct(F.lit("mrkdwn").alias("type"), text.alias("text"))).alias("elements"))
    divider = F.struct(F.lit("divider").alias("type"),
                       F.lit(None).cast("struct<type:string,text:string>").alias("text"),
                       F.lit(None).cast("array<struct<type:string,text:string>>").alias("elements"))
    header = block("header", "plain_text",
                   F.format_string(ALERT_HEADER, F.col("n")))
    context = ctx(F.format_string(ALERT_CONTEXT,
                                  first["date_before"], first["date_now"],
                                  day_gap(first["date_before"], first["date_now"]), F.lit(product)))
    sections = F.flatten(F.transform(F.slice(F.col("xs"), 1, max_sections),
                                     lambda x: F.array(block("section", "mrkdwn", x["text"]), divider)))
    more = F.when(F.col("n") > max_sections, F.array(ctx(F.format_string(
        ALERT_MORE, F.col("n") - max_sections, F.lit(product))))) \
        .otherwise(F.array().cast("array<struct<type:string,text:struct<type:string,text:string>,"
                                  "elements:array<struct<type:string,text:string>>>>"))
    blocks = F.concat(F.array(header, context, divider), sections, more)
    return g.select(F.to_json(F.struct(blocks.alias("blocks"))).alias("payload"), F.col("n").alias("count"))
