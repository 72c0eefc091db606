"""Alert payload documents."""
import json

from threatlake.plans import alerts as alr

SCHEMA = ("cve_id string, epss_before double, epss_now double, delta double, pct_change double, "
          "percentile double, date_before string, date_now string, description string, cvss_score double, "
          "cvss_severity string, cwe string")


def _sleepers(spark, n):
    rows = []
    for i in range(n):
        before, now = 0.01 + i / 1000, 0.6 + i / 100
        rows.append((f"CVE-2024-{i:05d}", before, now, now - before, (now - before) / before * 100, 0.97,
                     "2024-01-23", "2024-01-30", "x" * (300 if i == 0 else 20),
                     None if i == 1 else 9.8, "CRITICAL" if i != 1 else "", "CWE-94" if i == 0 else "NVD-CWE-noinfo"))
    return spark.createDataFrame(rows, SCHEMA)


def test_chat_payload_caps_sections(spark):
    doc = json.loads(alr.chat_payload(_sleepers(spark, 15)).first().payload)
    blocks = doc["blocks"]
    assert blocks[0]["type"] == "header" and "15 CVEs crossed 50% EPSS" in blocks[0]["text"]["text"]
    assert "Baseline *2024-01-23* vs *2024-01-30* (7-day lookback)" in blocks[1]["elements"][0]["text"]
    sections = [b for b in blocks if b["type"] == "section"]
    assert len(sections) == 10
    assert blocks[-1]["type"] == "context" and "and 5 more" in blocks[-1]["elements"][0]["text"]
    # largest rise first
    assert sections[0]["text"]["text"].startswith("*<https://nvd.nist.gov/vuln/detail/CVE-2024-00014|CVE-2024-00014>*")


def test_chat_section_lines(spark):
    doc = json.loads(alr.chat_payload(_sleepers(spark, 2)).first().payload)
    texts = {b["text"]["text"].split("|")[1].split(">")[0]: b["text"]["text"]
             for b in doc["blocks"] if b["type"] == "section"}
    first = texts["CVE-2024-00000"]
    assert ":red_circle: CVSS *9.8* (CRITICAL) | CWE-94" in first
    assert first.endswith("\n>" + "x" * 197 + "...")
    assert "CVSS: _n/a_" in texts["CVE-2024-00001"] and "NVD-CWE" not in texts["CVE-2024-00001"]
    assert not any(b["type"] == "context" and "more" in json.dumps(b) for b in doc["blocks"][2:])


def test_generic_payload(spark):
    doc = json.loads(alr.generic_payload(_sleepers(spark, 3), "2024-01-31 00:00:00").first().payload)
    assert doc["event"] == "sleeper_cve_alert" and doc["count"] == 3 and doc["timestamp"] == "2024-01-31T00:00:00Z"
    assert [s["cve_id"] for s in doc["sleepers"]] == ["CVE-2024-00002", "CVE-2024-00001", "CVE-2024-00000"]
    assert doc["sleepers"][1]["cvss_score"] is None and "cvss_score" in doc["sleepers"][1]


def test_no_payload_without_sleepers(spark):
    assert alr.chat_payload(_sleepers(spark, 0)).count() == 0
