"""Projections out of the JSON documents kept on CVE and analysis rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threatlake.functions.common import col_of

V31_SCORE = "$.metrics.cvssMetricV31[0].cvssData.baseScore"
V30_SCORE = "$.metrics.cvssMetricV30[0].cvssData.baseScore"
V31_SEVERITY = "$.metrics.cvssMetricV31[0].cvssData.baseSeverity"
FIRST_DESCRIPTION = "$.descriptions[0].value"
FIRST_CWE = "$.weaknesses[0].description[0].value"


def cvss_base_score(json_col) -> Column:
    """First CVSS v3.1 base score, else first v3.0, else NULL (bad JSON / empty arrays
    give NULL). DECIMAL(3,1) like the stored column."""
    j = col_of(json_col)
    return F.coalesce(F.get_json_object(j, V31_SCORE).try_cast("decimal(3,1)"),
                      F.get_json_object(j, V30_SCORE).try_cast("decimal(3,1)"))


def cve_description(json_col) -> Column:
    return F.coalesce(F.get_json_object(col_of(json_col), FIRST_DESCRIPTION), F.lit(""))


def cve_severity(json_col) -> Column:
    return F.coalesce(F.get_json_object(col_of(json_col), V31_SEVERITY), F.lit(""))


def cve_cwe(json_col) -> Column:
    return F.coalesce(F.get_json_object(col_of(json_col), FIRST_CWE), F.lit(""))


def description_en(json_col) -> Column:
    """Value of the first English entry of ``descriptions`` (NULL when none)."""
    descs = F.from_json(col_of(json_col), "struct<descriptions: array<struct<lang: string, value: string>>>")
    return F.get(F.filter(descs["descriptions"], lambda d: d["lang"] == "en"), 0)["value"]


# Fields of a KEV catalog entry projected by the dashboards and API.
KEV_PROJECTION = [("vendorProject", "vendor"), ("product", "product"),
                  ("vulnerabilityName", "vulnerability"), ("dateAdded", "date_added"),
                  ("requiredAction", "required_action"), ("dueDate", "due_date")]


def kev_field(json_col, field: str) -> Column:
    return F.get_json_object(col_of(json_col), f"$.{field}")


def json_array_size(json_col) -> Column:
    """Number of elements of a JSON array held as text (0 for NULL / not an array)."""
    return F.coalesce(F.json_array_length(col_of(json_col)), F.lit(0))


def cve_published(json_col) -> Column:
    """Publication time of an NVD CVE object (``$.published``, zone-less UTC) — the column
    the incremental selection windows run on."""
    return F.try_to_timestamp(F.get_json_object(col_of(json_col), "$.published")).cast("timestamp_ntz")


def parse_rfc3339(ts_text, fallback) -> Column:
    """RFC 3339 / ISO text to a UTC TIMESTAMP_NTZ; zone-less text is read as UTC;
    unparseable -> ``fallback``."""
    parsed = F.try_to_timestamp(col_of(ts_text))
    return F.coalesce(parsed.cast("timestamp_ntz"), col_of(fallback))
