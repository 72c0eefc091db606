"""Landed NVD pages, KEV catalogs and EPSS pages -> CVE and score rows.

Each source has a reader (batch, ``spark.read``) and a transform over the parsed page
rows, so the same projection runs in batch jobs and inside a stream's ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatlake.functions.json_fields import cvss_base_score, parse_rfc3339
from threatlake.operators.snapshots import ts_lit
from threatlake.schemas import EPSS_PAGE, KEV_CATALOG, KEV_FIELDS, NVD_PAGE


def _read(spark, path, schema, multi_line):
    return (spark.read.schema(schema).option("multiLine", multi_line).json(path)
            .withColumn("_file", F.col("_metadata.file_path")))


def snapshot_key(path_col: str = "_file"):
    """Folder of a landed page: one folder per download (snapshot / window / catalog)."""
    return F.regexp_extract(F.col(path_col), r"^(.*)/[^/]+$", 1)


# --------------------------------------------------------------------- NVD --------
def nvd_rows(pages: DataFrame, now) -> DataFrame:
    """One ``cve_enriched`` row per vulnerability; the raw ``cve`` object is kept as JSON
    text, the score is the v3.1 / v3.0 base score, ``modified`` is ``lastModified``
    (zone-less text read as UTC; unparseable -> ``now``)."""
    v = pages.select(F.explode("vulnerabilities").alias("v")).select(F.col("v.cve").alias("json"))
    return v.select(
        F.get_json_object("json", "$.id").alias("cve_id"), F.lit("NVD").alias("source"), "json",
        cvss_base_score("json").alias("cvss_base"), F.lit(None).cast("decimal(6,5)").alias("epss"),
        parse_rfc3339(F.get_json_object("json", "$.lastModified"), ts_lit(now)).alias("modified"))


def read_nvd_pages(spark: SparkSession, path, now, multi_line: bool = True) -> DataFrame:
    return nvd_rows(_read(spark, path, NVD_PAGE, multi_line), now)


def nvd_page_stats(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    pages = _read(spark, path, NVD_PAGE, multi_line)
    return pages.select("_file", F.col("startIndex").alias("offset"), F.col("totalResults").alias("total"),
                        F.size("vulnerabilities").alias("rows"))


# --------------------------------------------------------------------- KEV --------
def kev_header(catalogs: DataFrame) -> DataFrame:
    return catalogs.select("catalogVersion", "dateReleased", "count", "_file")


def kev_rows(catalogs: DataFrame, now) -> DataFrame:
    """One ``cve_enriched`` row per catalog entry with the nine known fields
    re-serialised (unknown fields dropped); ``modified`` = catalog release time."""
    released = F.try_to_timestamp(F.col("dateReleased")).cast("timestamp_ntz")
    e = catalogs.select(F.coalesce(released, ts_lit(now)).alias("modified"), F.explode("vulnerabilities").alias("v"))
    return e.select(
        F.col("v.cveID").alias("cve_id"), F.lit("CISA-KEV").alias("source"),
        F.to_json(F.struct(*[F.col(f"v.{f}").alias(f) for f in KEV_FIELDS]), {"ignoreNullFields": "false"}).alias("json"),
        F.lit(None).cast("decimal(3,1)").alias("cvss_base"), F.lit(None).cast("decimal(6,5)").alias("epss"),
        "modified")


def read_kev_catalog(spark: SparkSession, path, now, multi_line: bool = True):
    """(header, rows) of landed catalog files."""
    cat = _read(spark, path, KEV_CATALOG, multi_line)
    return kev_header(cat), kev_rows(cat, now)


# -------------------------------------------------------------------- EPSS --------
def epss_rows(pages: DataFrame, snapshot_col: str | None = None) -> DataFrame:
    """``epss_daily`` rows: scores cast exactly from text, every row of a snapshot stamped
    with the date of its first page (lowest offset). Without ``snapshot_col`` the whole
    input is one snapshot (a scalar subquery picks the date); with it, the date is
    picked per snapshot by a keyed ``min_by`` and joined back."""
    if snapshot_col is None:
        first_date = pages.select(F.min_by(F.get(F.col("data"), 0)["date"], F.col("offset"))).scalar()
        rows = pages.select(F.to_date(first_date).alias("as_of"), F.explode("data").alias("d"))
    else:
        firsts = pages.groupBy(snapshot_col).agg(
            F.to_date(F.min_by(F.get(F.col("data"), 0)["date"], F.col("offset"))).alias("as_of"))
        rows = pages.select(snapshot_col, F.explode("data").alias("d")).join(firsts, snapshot_col)
    return rows.select(
        "as_of", F.col("d.cve").alias("cve_id"),
        F.col("d.epss").try_cast("decimal(6,5)").alias("epss"),
        F.col("d.percentile").try_cast("double").alias("percentile"))


def read_epss_pages(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    """Rows of one landed snapshot (a folder of pages)."""
    return epss_rows(_read(spark, path, EPSS_PAGE, multi_line))


def epss_page_stats(spark: SparkSession, path, multi_line: bool = True) -> DataFrame:
    pages = _read(spark, path, EPSS_PAGE, multi_line)
    return pages.select("_file", "offset", "total", F.size("data").alias("rows"))
