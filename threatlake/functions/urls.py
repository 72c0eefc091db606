"""Campaign URL functions, as Column expressions and as SQL functions.

The SQL forms are registered with ``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` so
Catalyst inlines them like any built-in expression (no Python in the plan).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

from threatlake.functions.common import col_of

# The normalisation steps, applied in this order after lower-casing.
URL_SCHEME_AND_WWW = r"^https?://(www\.)?"
URL_QUERY_AND_FRAGMENT = r"[?#].*$"
URL_TRAILING_SLASHES = r"/+$"


def normalise_campaign_url(u) -> Column:
    """Lower-case, then drop scheme and ``www.``, query and fragment, trailing slashes."""
    x = F.lower(col_of(u))
    x = F.regexp_replace(x, URL_SCHEME_AND_WWW, "")
    x = F.regexp_replace(x, URL_QUERY_AND_FRAGMENT, "")
    return F.regexp_replace(x, URL_TRAILING_SLASHES, "")


REF_SCHEMA = "array<struct<url: string>>"


def reference_urls(refs) -> Column:
    """``refs[].url`` of a JSON array of reference objects (NULL for bad JSON)."""
    return F.transform(F.from_json(col_of(refs), REF_SCHEMA), lambda r: r["url"])


def first_matching_url(refs, pattern: str) -> Column:
    """First ``refs[].url`` matching the regular expression ``pattern``."""
    urls = F.filter(reference_urls(refs), lambda u: u.rlike(pattern))
    return F.get(urls, 0)


def pick_campaign_key(refs, fallback_id) -> Column:
    """Normalised first reference URL, else ``analysis:<fallback_id>``."""
    key = normalise_campaign_url(first_matching_url(refs, ".*"))
    key = F.when(key == "", F.lit(None)).otherwise(key)
    return F.coalesce(key, F.concat(F.lit("analysis:"), col_of(fallback_id).cast("string")))


def register_sql_functions(spark: SparkSession) -> None:
    """SQL access: normalise_campaign_url(u), first_matching_url(refs, pattern),
    pick_campaign_key(refs, fallback_id) — inlined SQL expressions."""
    norm = ("regexp_replace(regexp_replace(regexp_replace(lower(u), '{a}', ''), '{b}', ''), '{c}', '')"
            .format(a=URL_SCHEME_AND_WWW.replace("\\", "\\\\"), b=URL_QUERY_AND_FRAGMENT,
                    c=URL_TRAILING_SLASHES))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION normalise_campaign_url(u STRING) RETURNS STRING "
              f"RETURN {norm}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION first_matching_url(refs STRING, pattern STRING) "
              "RETURNS STRING RETURN get(filter(transform(from_json(refs, 'array<struct<url: string>>'), "
              "r -> r.url), x -> x rlike pattern), 0)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION pick_campaign_key(refs STRING, fallback_id STRING) "
              "RETURNS STRING RETURN coalesce(nullif(normalise_campaign_url(first_matching_url(refs, '.*')), ''), "
              "'analysis:' || fallback_id)")
