"""DuckDB CTEs that build the same domain tables as ``threatlake.sources.bindings``.

``with_tables(body, *names)`` prefixes a query with the CTEs it needs (dependencies are
added automatically) so that every oracle query reads only the driver's raw views.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

_CVE = "'CVE-2024-' || CASE WHEN {x} < 10000 THEN lpad(CAST({x} AS VARCHAR), 5, '0') ELSE CAST({x} AS VARCHAR) END"

_METRIC = ("'{{\"cvssData\":{{\"baseScore\":' || {score} || ',\"baseSeverity\":\"' || {sev} || '\"}}}}'")

_SCORE = "CAST(p_size // 5 AS VARCHAR) || '.' || CAST((p_size % 5) * 2 AS VARCHAR)"
_SEV = ("CASE WHEN p_size >= 45 THEN 'CRITICAL' WHEN p_size >= 35 THEN 'HIGH' "
        "WHEN p_size >= 20 THEN 'MEDIUM' ELSE 'LOW' END")
_V31 = "'\"cvssMetricV31\":[' || " + _METRIC.format(score=_SCORE, sev=_SEV) + " || ']'"
_V30 = "'\"cvssMetricV30\":[' || " + _METRIC.format(score=_SCORE, sev=_SEV) + " || ']'"
_V30_LOW = "'\"cvssMetricV30\":[' || " + _METRIC.format(score="'1.0'", sev="'LOW'") + " || ']'"

CVSS_FROM_JSON = ("COALESCE(TRY_CAST(json_extract_string({j}, '$.metrics.cvssMetricV31[0].cvssData.baseScore') "
                  "AS DECIMAL(3,1)), TRY_CAST(json_extract_string({j}, "
                  "'$.metrics.cvssMetricV30[0].cvssData.baseScore') AS DECIMAL(3,1)))")

CTES: dict[str, tuple[list[str], str]] = {
    "epss_daily": ([], f"""
        WITH d AS (
          SELECT CAST(ts AS DATE) AS as_of, {_CVE.format(x='user_id')} AS cve_id,
                 CAST(least(max(value) / 100.0, 1.0) AS DECIMAL(6,5)) AS epss
          FROM events GROUP BY 1, 2)
        SELECT as_of, cve_id, epss,
               percent_rank() OVER (PARTITION BY as_of ORDER BY epss) AS percentile
        FROM d"""),
    "nvd_json": ([], f"""
        SELECT p_partkey, {_CVE.format(x='p_partkey')} AS cve_id,
          '{{"id":"' || {_CVE.format(x='p_partkey')} || '","descriptions":[{{"lang":"en","value":"' || p_name
          || '"}}],"metrics":' ||
          CASE p_partkey % 4
            WHEN 0 THEN '{{' || {_V31} || ',' || {_V30_LOW} || '}}'
            WHEN 1 THEN '{{' || {_V31} || '}}'
            WHEN 2 THEN '{{' || {_V30} || '}}'
            ELSE '{{}}' END
          || ',"weaknesses":[{{"description":[{{"lang":"en","value":"CWE-' || substr(p_brand, 7)
          || '"}}]}}]}}' AS json
        FROM part"""),
    "cve_enriched": (["nvd_json"], f"""
        SELECT cve_id, 'NVD' AS source, json, {CVSS_FROM_JSON.format(j='json')} AS cvss_base,
               CAST(NULL AS DECIMAL(6,5)) AS epss,
               CAST(DATE '2024-01-30' - CAST(p_partkey % 60 AS INTEGER) AS TIMESTAMP) AS modified
        FROM nvd_json
        UNION ALL
        SELECT {_CVE.format(x='s_suppkey * 3')} AS cve_id, 'CISA-KEV' AS source,
          '{{"vendorProject":"' || s_name || '","product":"product-' || CAST(s_nationkey AS VARCHAR)
          || '","vulnerabilityName":"' || s_name || ' vulnerability' || '","dateAdded":"'
          || CAST(DATE '2024-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS VARCHAR)
          || '","requiredAction":"Apply updates per vendor instructions.","dueDate":"'
          || CAST(DATE '2024-01-22' + CAST(s_suppkey % 28 AS INTEGER) AS VARCHAR) || '"}}' AS json,
          CAST(NULL AS DECIMAL(3,1)) AS cvss_base, CAST(NULL AS DECIMAL(6,5)) AS epss,
          TIMESTAMP '2024-01-28 00:00:00' AS modified
        FROM supplier"""),
    "current": ([], f"""
        SELECT sha256('doc-' || CAST(doc_id AS VARCHAR) || chr(1) || source) AS id,
          'doc-' || CAST(doc_id AS VARCHAR) AS guid,
          CASE WHEN doc_id % 90 = 0 THEN '' ELSE text END AS title,
          'https://example.org/' || CAST(doc_id AS VARCHAR) AS link,
          source AS feed_url,
          {AS_OF} - to_hours(CAST(doc_id % 720 AS BIGINT)) AS published,
          {AS_OF} - to_hours(CAST(doc_id % 720 AS BIGINT)) AS entry_updated,
          CAST(NULL AS TIMESTAMP) AS feed_updated,
          CASE WHEN doc_id % 6 = 0 THEN '' WHEN doc_id % 10 = 1 THEN NULL ELSE text END AS content,
          CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 9 = 0 THEN '' ELSE text END AS summary,
          '' AS author, [lang, source] AS categories, source AS feed_title,
          CAST(NULL AS VARCHAR) AS feed_description, lang AS feed_language,
          CAST(NULL AS VARCHAR) AS feed_icon,
          {AS_OF} - to_hours(CAST(doc_id % 720 AS BIGINT)) AS inserted_at
        FROM documents"""),
    "archive": (["current"], "SELECT * FROM current"),
    "analysis": ([], f"""
        SELECT 'an-' || CAST(d.doc_id AS VARCHAR) AS analysis_id,
          'ag-' || CAST(d.doc_id AS VARCHAR) AS analysis_guid,
          sha256('doc-' || CAST(d.doc_id AS VARCHAR) || chr(1) || d.source) AS archive_id,
          'doc-' || CAST(d.doc_id AS VARCHAR) AS archive_guid,
          d.source AS source_name, d.text AS title,
          CASE d.doc_id % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity_level,
          CAST(d.doc_id % 101 AS INTEGER) AS confidence_pct,
          d.text AS summary_impact,
          CASE WHEN d.doc_id % 3 = 0 THEN 'high' ELSE 'medium' END AS relevance,
          {AS_OF} - to_hours(CAST(d.doc_id % 720 AS BIGINT)) AS analysed_at,
          CASE d.doc_id % 3 WHEN 0 THEN '["patch"]' WHEN 1 THEN '["patch","monitor"]' ELSE '[]' END AS recommended_actions,
          CASE d.doc_id % 4
            WHEN 0 THEN '[{{"type":"domain","value":"host' || CAST(d.doc_id AS VARCHAR) || '.example.net","context":"c2 server"}}]'
            WHEN 1 THEN '{{"indicator_type":"ip","indicator":"10.0.' || CAST(d.doc_id % 256 AS VARCHAR) || '.'
                        || CAST(d.doc_id % 7 AS VARCHAR) || '","note":"seen in logs"}}'
            WHEN 2 THEN 'evil-' || CAST(d.doc_id AS VARCHAR) || '.example.com'
            ELSE NULL END AS key_iocs,
          '["CVE-2024-' || lpad(CAST(d.doc_id % k.n_cves AS VARCHAR), greatest(5, length(CAST(d.doc_id % k.n_cves AS VARCHAR)))::INTEGER, '0')
            || '","CVE-2024-' || lpad(CAST(d.doc_id * 7 % k.n_cves AS VARCHAR), greatest(5, length(CAST(d.doc_id * 7 % k.n_cves AS VARCHAR)))::INTEGER, '0') || '"'
            || CASE WHEN d.doc_id % 13 = 0 THEN ',"CVE-24-1"' ELSE '' END || ']' AS cve_references,
          CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE '[{{"url":"' || u.url || '"}}]' END AS exploit_references
        FROM documents d
        CROSS JOIN (SELECT (SELECT max(page_id) + 1 FROM pages) AS n_pages,
                           (SELECT greatest(150, (max(doc_id) + 1) // 4) FROM documents) AS n_cves) k
        LEFT JOIN (SELECT page_id, min(url) AS url FROM pages GROUP BY page_id) u
          ON u.page_id = d.doc_id % k.n_pages"""),
    "fetch_log": ([], """
        SELECT 'feed-' || CAST(user_id % 22 AS VARCHAR) AS feed_name,
          CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
          value / 10 AS duration_s, ts,
          CAST(json_extract_string(props, '$.k') AS INTEGER) AS items
        FROM events"""),
    "raw_docs": ([], """
        SELECT url, html AS body, 'text/html' AS content_type,
          CAST(CASE page_id % 10 WHEN 3 THEN 404 WHEN 7 THEN 403 ELSE 200 END AS INTEGER) AS status
        FROM pages"""),
    "item_versions": ([], """
        SELECT 'e-' || CAST(event_id AS VARCHAR) AS id, 'u' || CAST(user_id AS VARCHAR) AS guid,
          'event ' || CAST(event_id AS VARCHAR) AS title,
          'https://example.org/e/' || CAST(event_id AS VARCHAR) AS link,
          event_type AS feed_url, ts AS published, ts AS entry_updated,
          CAST(NULL AS TIMESTAMP) AS feed_updated, props AS content, event_type AS summary,
          '' AS author, [event_type] AS categories, event_type AS feed_title,
          CAST(NULL AS VARCHAR) AS feed_description,
          CASE WHEN event_id % 2 = 0 THEN 'en' ELSE 'de' END AS feed_language,
          CAST(NULL AS VARCHAR) AS feed_icon, ts AS inserted_at, event_id
        FROM events"""),
}


def with_tables(body: str, *names: str) -> str:
    """``WITH <ctes for names and their dependencies> <body>``."""
    order: list[str] = []

    def visit(n):
        if n in order or n not in CTES:  # raw driver tables need no CTE
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS ({CTES[n][1]})" for n in order]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
