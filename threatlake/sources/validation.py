"""Feed-document validation: classify each fetched document and report failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Snippet length of the failure report and its ellipsis.
SNIPPET_CHARS = 240
ELLIPSIS = "…"


def classify_document(status, content_type, body):
    """``HttpStatus <n>`` for non-2xx, ``Fetch`` for an empty response, ``UnexpectedHtml``
    for an HTML page where a feed was expected, else NULL (ok)."""
    head = F.lower(F.ltrim(F.coalesce(F.col(body), F.lit(""))))
    is_html = (F.lower(F.coalesce(F.col(content_type), F.lit(""))).contains("html")
               | head.startswith("<!doctype html") | head.startswith("<html"))
    return (F.when((F.col(status) < 200) | (F.col(status) >= 300), F.concat(F.lit("HttpStatus "), F.col(status).cast("string")))
            .when(F.coalesce(F.col(body), F.lit("")) == "", F.lit("Fetch"))
            .when(is_html, F.lit("UnexpectedHtml")))


def snippet(body) -> "F.Column":
    s = F.regexp_replace(F.coalesce(F.col(body), F.lit("")), "\n", " ")
    return F.when(F.length(s) > SNIPPET_CHARS, F.concat(F.substr(s, F.lit(1), F.lit(SNIPPET_CHARS)), F.lit(ELLIPSIS))) \
        .otherwise(s)


def validate_documents(docs: DataFrame, name_col: str = "url") -> DataFrame:
    """One row per document: name, ok flag, error kind, status, content type, snippet."""
    kind = classify_document("status", "content_type", "body")
    return docs.select(F.col(name_col).alias("name"), "url", kind.isNull().alias("ok"), kind.alias("error_kind"),
                       "status", "content_type", snippet("body").alias("snippet"))


def validation_failures(report: DataFrame) -> DataFrame:
    return report.where(~F.col("ok")).orderBy("name")


def validation_totals(report: DataFrame) -> DataFrame:
    return report.agg(F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("ok"),
                      F.count_if(~F.col("ok")).alias("fail"))
