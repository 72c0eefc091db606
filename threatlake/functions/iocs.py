"""Indicator and CVE-mention extraction from the enrichment JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threatlake.functions.common import col_of

# A well-formed CVE identifier; alternative field names of IOC objects,
# in order of preference.
CVE_TOKEN = r"^CVE-\d{4}-\d{4,}$"
CVE_IN_TEXT = r"(?i)CVE-\d{4}-\d{4,}"
IOC_TYPE_FIELDS = ["type", "ioc_type", "indicator_type"]
IOC_VALUE_FIELDS = ["value", "indicator", "ioc", "observable"]
IOC_CONTEXT_FIELDS = ["context", "note", "description"]


def cve_tokens(refs) -> Column:
    """Distinct upper-cased, trimmed tokens of a JSON array of CVE references."""
    arr = F.from_json(col_of(refs), "array<string>")
    return F.array_distinct(F.filter(F.transform(arr, lambda x: F.upper(F.trim(x))), lambda x: x.isNotNull()))


def valid_cve_tokens(refs) -> Column:
    return F.filter(cve_tokens(refs), lambda x: x.rlike(CVE_TOKEN))


def cve_mentions_in_text(*cols) -> Column:
    """Second extractor: every CVE-looking token in free text (distinct, upper-case)."""
    text = F.concat_ws(" ", *[col_of(c) for c in cols])
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(CVE_IN_TEXT), 0), lambda x: F.upper(x)))


def ioc_elements(key_iocs) -> Column:
    """The IOC list of one analysis as raw JSON texts (strings unquoted):
    JSON array -> its elements; JSON object -> itself; any other valid JSON -> none;
    text that is not JSON -> that text; NULL / blank -> none."""
    raw = col_of(key_iocs)
    t = F.ltrim(raw)
    parsed = F.try_parse_json(t)
    return (F.when(raw.isNull() | (F.trim(raw) == ""), F.array().cast("array<string>"))
            .when(parsed.isNull(), F.array(raw))
            .when(t.startswith("["), F.coalesce(F.from_json(t, "array<string>"), F.array().cast("array<string>")))
            .when(t.startswith("{"), F.array(t))
            .otherwise(F.array().cast("array<string>")))


def _first_field(x: Column, fields) -> Column:
    vals = [F.get_json_object(x, f"$.{f}") for f in fields]
    return F.coalesce(*[F.when(v != "", v) for v in vals])


def ioc_struct(x: Column) -> Column:
    """Normalised IOC of one element: objects map their alternative field names, other
    elements become the value."""
    is_obj = x.startswith("{") & F.try_parse_json(x).isNotNull()
    return F.struct(
        F.when(is_obj, _first_field(x, IOC_TYPE_FIELDS)).alias("ioc_type"),
        F.when(is_obj, _first_field(x, IOC_VALUE_FIELDS)).otherwise(x).alias("ioc_value"),
        F.when(is_obj, _first_field(x, ["confidence"])).alias("confidence"),
        F.when(is_obj, _first_field(x, IOC_CONTEXT_FIELDS)).alias("context"),
    )
