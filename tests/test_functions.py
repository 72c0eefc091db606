"""Column-function cases (CVSS extraction, badges, truncation, URLs, IOCs, grammar)."""
import json

import pytest
from pyspark.sql import functions as F

from threatlake.functions import iocs, json_fields, scores, text, urls
from threatlake.operators.query import relation_query


def _one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys())) if cols else spark.range(1)
    return df.select(expr.alias("x")).first().x


V31_ONLY = '{"metrics":{"cvssMetricV31":[{"cvssData":{"baseScore":9.8}}]}}'
V30_ONLY = '{"metrics":{"cvssMetricV30":[{"cvssData":{"baseScore":7.5}}]}}'
BOTH = ('{"metrics":{"cvssMetricV31":[{"cvssData":{"baseScore":9.0}}],'
        '"cvssMetricV30":[{"cvssData":{"baseScore":5.0}}]}}')
EMPTY_ARRAYS = '{"metrics":{"cvssMetricV31":[],"cvssMetricV30":[]}}'


@pytest.mark.parametrize("doc,expected", [
    (V31_ONLY, "9.8"), (V30_ONLY, "7.5"), (BOTH, "9.0"), (None, None), ("", None), ("{}", None),
    ("not json", None), (EMPTY_ARRAYS, None)])
def test_cvss_extraction(spark, doc, expected):
    v = _one(spark, json_fields.cvss_base_score(F.col("j")), j=doc) if doc is not None else \
        spark.range(1).select(json_fields.cvss_base_score(F.lit(None).cast("string")).alias("x")).first().x
    assert (None if v is None else str(v)) == expected


def test_cvss_badge(spark):
    assert _one(spark, scores.cvss_badge(F.lit(9.8), F.lit("CRITICAL"))) == ":red_circle: CVSS *9.8* (CRITICAL)"
    assert _one(spark, scores.cvss_badge(F.lit(7.0), F.lit(""))) == ":large_orange_circle: CVSS *7.0*"
    assert _one(spark, scores.cvss_badge(F.lit(4.2), F.lit("MEDIUM"))).startswith(":large_yellow_circle:")
    assert _one(spark, scores.cvss_badge(F.lit(1.0), F.lit("LOW"))).startswith(":large_green_circle:")
    assert _one(spark, scores.cvss_badge(F.lit(None).cast("double"), F.lit("HIGH"))) == "CVSS: _n/a_"


def test_cwe_display(spark):
    assert _one(spark, scores.cwe_display(F.lit("CWE-94"))) == " | CWE-94"
    for placeholder in ("", "NVD-CWE-noinfo", "NVD-CWE-Other"):
        assert _one(spark, scores.cwe_display(F.lit(placeholder))) == ""


def test_truncation(spark):
    long_text = "x" * 300
    out = _one(spark, text.truncate_text(F.lit(long_text)))
    assert len(out) == 200 and out.endswith("...")
    assert _one(spark, text.truncate_text(F.lit("short"))) == "short"


def test_pct_change_and_day_gap(spark):
    assert _one(spark, scores.pct_change(F.lit(0.05), F.lit(0.55))) == pytest.approx(1000.0)
    assert _one(spark, scores.pct_change(F.lit(0.0), F.lit(0.55))) == 0.0
    assert _one(spark, scores.day_gap(F.lit("2024-01-23"), F.lit("2024-01-30"))) == 7
    assert _one(spark, scores.day_gap(F.lit("bad"), F.lit("2024-01-30"))) == 0


def test_alert_line(spark):
    line = _one(spark, scores.epss_alert_line(F.lit(0.05), F.lit(0.6), F.lit(1100.0), F.lit(0.97)))
    assert line == "EPSS: 5.00% :arrow_right: *60.00%*  (+1100%)  |  Percentile: *97*"


def test_risk_score_half_up(spark):
    from decimal import Decimal
    v = _one(spark, scores.risk_score(F.lit(Decimal("9.5")).cast("decimal(3,1)"),
                                      F.lit(Decimal("0.50050")).cast("decimal(6,5)")))
    assert v == Decimal("4.75")  # 4.754750 -> 4.75


def test_campaign_url_functions(spark):
    refs = json.dumps([{"url": "HTTPS://www.Example.com/Path/?utm_source=rss#x"}, {"url": "https://b.example/x"}])
    assert _one(spark, urls.normalise_campaign_url(F.lit("https://Example.com/path/?utm_source=rss"))) == \
        "example.com/path"
    assert _one(spark, urls.first_matching_url(F.lit(refs), r"b\.example")) == "https://b.example/x"
    assert _one(spark, urls.pick_campaign_key(F.lit(refs), F.lit("id-1"))) == "example.com/path"
    assert _one(spark, urls.pick_campaign_key(F.lit(None).cast("string"), F.lit("id-1"))) == "analysis:id-1"


def test_sql_functions(spark):
    urls.register_sql_functions(spark)
    r = spark.sql("SELECT normalise_campaign_url('http://www.a.org/x//') AS a, "
                  "pick_campaign_key(NULL, 'z') AS b").first()
    assert (r.a, r.b) == ("a.org/x", "analysis:z")


@pytest.mark.parametrize("raw,expected", [
    ('[{"type":"ip","value":"1.2.3.4","context":"c2"}]', [("ip", "1.2.3.4", "c2")]),
    ('{"indicator_type":"domain","indicator":"bad.example","note":"n"}', [("domain", "bad.example", "n")]),
    ('[{"ioc_type":"","type":"","indicator_type":"hash","value":"","ioc":"abc"}]', [("hash", "abc", None)]),
    ('["plain-value", {"observable":"o1"}]', [(None, "plain-value", None), (None, "o1", None)]),
    ("not json at all", [(None, "not json at all", None)]),
    ('"a json string"', []), ("42", []), ("", []), (None, []), ("[]", []),
])
def test_ioc_normalisation(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "k string")
    rows = df.select(F.explode(F.transform(iocs.ioc_elements("k"), iocs.ioc_struct)).alias("i")) \
        .select("i.ioc_type", "i.ioc_value", "i.context").collect()
    assert [tuple(r) for r in rows] == expected


def test_cve_tokens(spark):
    df = spark.createDataFrame([('[" cve-2024-1234 ", "CVE-2024-1234", "CVE-24-1", "CVE-2023-123456"]',)], "r string")
    assert df.select(iocs.valid_cve_tokens("r")).first()[0] == ["CVE-2024-1234", "CVE-2023-123456"]
    assert df.select(iocs.cve_tokens("r")).first()[0] == ["CVE-2024-1234", "CVE-24-1", "CVE-2023-123456"]


def test_sanitize(spark):
    dirty = ('<SCRIPT type="text/javascript">exfil(\'k\')</SCRIPT><p>Plain advisory words</p>'
             '<img src=y ONMOUSEOVER="exfil(3)"><a href=\'javascript:exfil(4)\'>l</a><!-- note -->')
    clean = _one(spark, text.sanitize_html(F.lit(dirty)))
    assert "Plain advisory words" in clean
    for bad in ("<SCRIPT", "ONMOUSEOVER", "exfil(", "javascript:", "<!--"):
        assert bad not in clean


def test_sanitize_lets_no_markup_through(spark):
    cases = {
        "<svg/onload=alert(1)>x": "x",
        "<img src=x/onerror=alert(1)>": '<img src="x/onerror=alert(1)">',  # an unquoted value runs to the blank
        "a<script>alert(1)": "a",
        "<iframe src=x>in</iframe>b": "b",
        "<object data=x>c": "",
        '<a href="vbscript:x">v</a>': "<a>v</a>",
        "<a href=&#106;avascript:x>e</a>": "<a>e</a>",
        "<a href='java\tscript:x'>e</a>": "<a>e</a>",
        "<a title='<b onclick=x>'>e</a>": "&lt;a title='<b>'>e</a>",
        "<scr<script></script>ipt>alert(1)</script>": "alert(1)",
        "1 < 2 <b": "1 &lt; 2 &lt;b",
        '<A HREF="https://e.org/?a=1&b=2" onclick="x()">ok</A><P CLASS=q>t</P>': '<a href="https://e.org/?a=1&b=2">ok</a><p>t</p>',
        "<img alt='say \"hi\"' src=/i.png><!-- n --><!doctype html>": '<img src="/i.png" alt="say &quot;hi&quot;">',
        "<a href='javascript&colon;x'>e</a><a href='mailto:a@b.c'>m</a>": '<a>e</a><a href="mailto:a@b.c">m</a>',
        "": "", None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    got = {r[0]: r[1] for r in df.select("h", text.sanitize_html("h")).collect()}
    assert got == cases


def test_search_tokens(spark):
    toks = _one(spark, text.search_tokens(F.lit("Zero-day in Cisco IOS!"), F.lit(None).cast("string"), F.lit("cisco")))
    assert toks == sorted(["zero", "day", "in", "cisco", "ios"])


def test_relation_query_grammar(spark):
    df = spark.createDataFrame([(i, f"t{i}", None if i % 3 == 0 else i * 1.5, i % 2 == 0) for i in range(20)],
                               "id int, title string, score double, flag boolean")
    out = relation_query(df, select="id,score", filters=[("id", "gte", 5), ("flag", "is", True)],
                         order=["score.desc"], tiebreak=["id"], offset=1, limit=3).collect()
    # DESC puts NULL scores first (ids 6, 12, 18), offset 1 skips id 6
    assert [r.id for r in out] == [12, 18, 16]
    with pytest.raises(ValueError):
        relation_query(df, filters=[("nope", "eq", 1)])
    assert relation_query(df, filters=[("title", "ilike", "*T1*")]).count() == 11
    assert relation_query(df, limit=5000).count() == 20  # capped at 1000, fewer rows here
