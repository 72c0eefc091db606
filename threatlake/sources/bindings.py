"""Domain tables derived, as Spark jobs, from the driver's generic test tables.

The mappings are the bindings B1–B7 of FIXTURES.md: every domain table is a pure
DataFrame function of the given parquet tables, so all work grows with them. The DuckDB
twins of these functions live in ``threatlake.oracle.bindings``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from threatlake.functions.json_fields import cvss_base_score
from threatlake.functions.ranking import percent_rank_within

# "now" of every time-relative query over the bindings.
AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
AS_OF_LIT = "2024-01-31 00:00:00"
# Split point of B7: versions before it are "existing", the rest the incoming batch.
B7_SPLIT = "2024-01-16 00:00:00"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def as_of_ts():
    return F.lit(AS_OF_LIT).cast("timestamp_ntz")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _five_digits(num_col) -> "F.Column":
    """The number with at least five digits; longer ones stay whole."""
    s = num_col.cast("string")
    return F.when(F.length(s) < 5, F.lpad(s, 5, "0")).otherwise(s)


def _cve_id(num_col) -> "F.Column":
    return F.concat(F.lit("CVE-2024-"), _five_digits(num_col))


def _hours_before_as_of(n_col):
    return as_of_ts() - F.make_dt_interval(hours=n_col.cast("int"))


# B1 -------------------------------------------------------------------------------
def epss_daily(events: DataFrame) -> DataFrame:
    """One score per (day, user) = max(value)/100 capped at 1; percentile = percent rank
    of the score within the day."""
    d = (events.groupBy(F.to_date("ts").alias("as_of"), _cve_id(F.col("user_id")).alias("cve_id"))
         .agg(F.least(F.max("value") / 100.0, F.lit(1.0)).cast("decimal(6,5)").alias("epss")))
    return percent_rank_within(d, "as_of", "epss", "percentile") \
        .select("as_of", "cve_id", "epss", "percentile")


# B2 -------------------------------------------------------------------------------
def _cvss_metric(score, severity):
    return F.concat(F.lit('{"cvssData":{"baseScore":'), score, F.lit(',"baseSeverity":"'),
                    severity, F.lit('"}}'))


def nvd_rows(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    js = _nvd_json(part)
    return part.select(
        _cve_id(pk).alias("cve_id"),
        F.lit("NVD").alias("source"),
        js.alias("json"),
        cvss_base_score(js).alias("cvss_base"),
        F.lit(None).cast("decimal(6,5)").alias("epss"),
        F.date_sub(F.lit("2024-01-30").cast("date"), (pk % 60).cast("int")).cast("timestamp_ntz").alias("modified"),
    )


def kev_rows(supplier: DataFrame) -> DataFrame:
    sk = F.col("s_suppkey")
    added = F.date_add(F.lit("2024-01-01").cast("date"), (sk % 28).cast("int")).cast("string")
    due = F.date_add(F.lit("2024-01-22").cast("date"), (sk % 28).cast("int")).cast("string")
    js = F.concat(F.lit('{"vendorProject":"'), F.col("s_name"),
                  F.lit('","product":"product-'), F.col("s_nationkey").cast("string"),
                  F.lit('","vulnerabilityName":"'), F.col("s_name"), F.lit(' vulnerability'),
                  F.lit('","dateAdded":"'), added,
                  F.lit('","requiredAction":"Apply updates per vendor instructions.","dueDate":"'), due,
                  F.lit('"}'))
    return supplier.select(
        _cve_id(sk * 3).alias("cve_id"),
        F.lit("CISA-KEV").alias("source"),
        js.alias("json"),
        F.lit(None).cast("decimal(3,1)").alias("cvss_base"),
        F.lit(None).cast("decimal(6,5)").alias("epss"),
        F.lit("2024-01-28 00:00:00").cast("timestamp_ntz").alias("modified"),
    )


def cve_enriched(part: DataFrame, supplier: DataFrame) -> DataFrame:
    return nvd_rows(part).unionByName(kev_rows(supplier))


def _nvd_json(part):
    pk, size = F.col("p_partkey"), F.col("p_size")
    score = F.concat(F.expr("p_size div 5").cast("string"), F.lit("."), ((size % 5) * 2).cast("string"))
    sev = (F.when(size >= 45, "CRITICAL").when(size >= 35, "HIGH").when(size >= 20, "MEDIUM")
           .otherwise("LOW"))
    v31 = F.concat(F.lit('"cvssMetricV31":['), _cvss_metric(score, sev), F.lit("]"))
    v30 = F.concat(F.lit('"cvssMetricV30":['), _cvss_metric(score, sev), F.lit("]"))
    v30_low = F.concat(F.lit('"cvssMetricV30":['), _cvss_metric(F.lit("1.0"), F.lit("LOW")), F.lit("]"))
    kind = pk % 4
    metrics = (F.when(kind == 0, F.concat(F.lit("{"), v31, F.lit(","), v30_low, F.lit("}")))
               .when(kind == 1, F.concat(F.lit("{"), v31, F.lit("}")))
               .when(kind == 2, F.concat(F.lit("{"), v30, F.lit("}")))
               .otherwise(F.lit("{}")))
    return F.concat(F.lit('{"id":"'), _cve_id(pk), F.lit('","descriptions":[{"lang":"en","value":"'),
                    F.col("p_name"), F.lit('"}],"metrics":'), metrics,
                    F.lit(',"weaknesses":[{"description":[{"lang":"en","value":"CWE-'),
                    F.substr(F.col("p_brand"), F.lit(7)), F.lit('"}]}]}'))


# B3 -------------------------------------------------------------------------------
def feed_items(documents: DataFrame) -> DataFrame:
    """``current`` (and, with one version per key, ``archive``) from documents."""
    did, text = F.col("doc_id"), F.col("text")
    guid = F.concat(F.lit("doc-"), did.cast("string"))
    ts = _hours_before_as_of(did % 720)
    return documents.select(
        F.sha2(F.concat_ws("\u0001", guid, F.col("source")), 256).alias("id"),
        guid.alias("guid"),
        F.when(did % 90 == 0, F.lit("")).otherwise(text).alias("title"),
        F.concat(F.lit("https://example.org/"), did.cast("string")).alias("link"),
        F.col("source").alias("feed_url"),
        ts.alias("published"),
        ts.alias("entry_updated"),
        F.lit(None).cast("timestamp_ntz").alias("feed_updated"),
        F.when(did % 6 == 0, F.lit("")).when(did % 10 == 1, F.lit(None)).otherwise(text).alias("content"),
        F.when(did % 4 == 0, F.lit(None)).when(did % 9 == 0, F.lit(""))
         .otherwise(text).alias("summary"),
        F.lit("").alias("author"),
        F.array(F.col("lang"), F.col("source")).alias("categories"),
        F.col("source").alias("feed_title"),
        F.lit(None).cast("string").alias("feed_description"),
        F.col("lang").alias("feed_language"),
        F.lit(None).cast("string").alias("feed_icon"),
        ts.alias("inserted_at"),
    )


# B4 -------------------------------------------------------------------------------
def analysis(documents: DataFrame, pages: DataFrame) -> DataFrame:
    did = F.col("doc_id")
    # Moduli follow the tables, so that pages and mentioned CVEs grow with the documents.
    n_pages = (pages.agg(F.max("page_id")).first()[0] or 0) + 1
    n_cves = max(150, ((documents.agg(F.max("doc_id")).first()[0] or 0) + 1) // 4)
    urls = pages.groupBy("page_id").agg(F.min("url").alias("url"))
    docs = documents.withColumn("page_id", did % n_pages).join(urls, "page_id", "left")
    ref = lambda n: F.concat(F.lit('"CVE-2024-'), _five_digits(n), F.lit('"'))
    cves = F.concat(F.lit("["), ref(did % n_cves), F.lit(","), ref(did * 7 % n_cves),
                    F.when(did % 13 == 0, F.lit(',"CVE-24-1"')).otherwise(F.lit("")), F.lit("]"))
    iocs = (F.when(did % 4 == 0, F.concat(F.lit('[{"type":"domain","value":"host'), did.cast("string"),
                                          F.lit('.example.net","context":"c2 server"}]')))
            .when(did % 4 == 1, F.concat(F.lit('{"indicator_type":"ip","indicator":"10.0.'),
                                         (did % 256).cast("string"), F.lit("."), (did % 7).cast("string"),
                                         F.lit('","note":"seen in logs"}')))
            .when(did % 4 == 2, F.concat(F.lit("evil-"), did.cast("string"), F.lit(".example.com"))))
    return docs.select(
        F.concat(F.lit("an-"), did.cast("string")).alias("analysis_id"),
        F.concat(F.lit("ag-"), did.cast("string")).alias("analysis_guid"),
        F.sha2(F.concat_ws("\u0001", F.concat(F.lit("doc-"), did.cast("string")), F.col("source")), 256)
         .alias("archive_id"),
        F.concat(F.lit("doc-"), did.cast("string")).alias("archive_guid"),
        F.col("source").alias("source_name"),
        F.col("text").alias("title"),
        F.when(did % 4 == 0, "CRITICAL").when(did % 4 == 1, "HIGH").when(did % 4 == 2, "MEDIUM")
         .otherwise("LOW").alias("severity_level"),
        (did % 101).cast("int").alias("confidence_pct"),
        F.col("text").alias("summary_impact"),
        F.when(did % 3 == 0, "high").otherwise("medium").alias("relevance"),
        _hours_before_as_of(did % 720).alias("analysed_at"),
        F.when(did % 3 == 0, F.lit('["patch"]')).when(did % 3 == 1, F.lit('["patch","monitor"]'))
         .otherwise(F.lit("[]")).alias("recommended_actions"),
        iocs.alias("key_iocs"),
        cves.alias("cve_references"),
        F.when(did % 5 == 0, F.lit(None))
         .otherwise(F.concat(F.lit('[{"url":"'), F.col("url"), F.lit('"}]'))).alias("exploit_references"),
    )


# B5 -------------------------------------------------------------------------------
def fetch_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("feed-"), (F.col("user_id") % 22).cast("string")).alias("feed_name"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 10).alias("duration_s"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("items"),
    )


# B6 -------------------------------------------------------------------------------
def raw_docs(pages: DataFrame) -> DataFrame:
    pid = F.col("page_id")
    return pages.select(
        F.col("url"), F.col("html").alias("body"), F.lit("text/html").alias("content_type"),
        F.when(pid % 10 == 3, 404).when(pid % 10 == 7, 403).otherwise(200).cast("int").alias("status"),
    )


# B7 -------------------------------------------------------------------------------
def item_versions(events: DataFrame) -> DataFrame:
    """Feed-item versions: key (user_id, event_type) plays (guid, feed_url); the order
    column pair is (published, event_id)."""
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp_ntz")
    return events.select(
        F.concat(F.lit("e-"), eid.cast("string")).alias("id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("guid"),
        F.concat(F.lit("event "), eid.cast("string")).alias("title"),
        F.concat(F.lit("https://example.org/e/"), eid.cast("string")).alias("link"),
        F.col("event_type").alias("feed_url"),
        ts.alias("published"),
        ts.alias("entry_updated"),
        F.lit(None).cast("timestamp_ntz").alias("feed_updated"),
        F.col("props").alias("content"),
        F.col("event_type").alias("summary"),
        F.lit("").alias("author"),
        F.array(F.col("event_type")).alias("categories"),
        F.col("event_type").alias("feed_title"),
        F.lit(None).cast("string").alias("feed_description"),
        F.when(eid % 2 == 0, "en").otherwise("de").alias("feed_language"),
        F.lit(None).cast("string").alias("feed_icon"),
        ts.alias("inserted_at"),
        eid.alias("event_id"),
    )


class Tables:
    """Lazily built domain tables over one ``sf_dir`` (each a DataFrame, never cached)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        # Domain times are UTC wall clock; conversions between TIMESTAMP and
        # TIMESTAMP_NTZ (zone parsing, watermarks, epoch seconds) assume a UTC session.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def raw(self, name):
        return read(self.spark, self.sf_dir, name)

    @property
    def epss_daily(self):
        return epss_daily(self.raw("events"))

    @property
    def cve_enriched(self):
        return cve_enriched(self.raw("part"), self.raw("supplier"))

    @property
    def current(self):
        return feed_items(self.raw("documents"))

    archive = current

    @property
    def analysis(self):
        return analysis(self.raw("documents"), self.raw("pages"))

    @property
    def fetch_log(self):
        return fetch_log(self.raw("events"))

    @property
    def raw_docs(self):
        return raw_docs(self.raw("pages"))

    @property
    def item_versions(self):
        return item_versions(self.raw("events"))
