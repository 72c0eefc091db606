"""Explicit schemas of the domain tables (never inferred).

All timestamps are UTC wall-clock values stored as TIMESTAMP_NTZ; scores keep the
exact NUMERIC semantics of the source system as DECIMAL.
"""

from pyspark.sql import types as T

S, NTZ, D = T.StringType(), T.TimestampNTZType(), T.DateType()

EPSS = T.DecimalType(6, 5)
CVSS = T.DecimalType(3, 1)

# archive (insert-if-absent) and current (last write wins) share one shape.
FEED_ITEM = T.StructType([
    T.StructField("id", S, False),
    T.StructField("guid", S, False),
    T.StructField("title", S, False),
    T.StructField("link", S, False),
    T.StructField("feed_url", S, False),
    T.StructField("published", NTZ, True),
    T.StructField("entry_updated", NTZ, True),
    T.StructField("feed_updated", NTZ, True),
    T.StructField("content", S, True),
    T.StructField("summary", S, True),
    T.StructField("author", S, True),
    T.StructField("categories", T.ArrayType(S), True),
    T.StructField("feed_title", S, True),
    T.StructField("feed_description", S, True),
    T.StructField("feed_language", S, True),
    T.StructField("feed_icon", S, True),
    T.StructField("inserted_at", NTZ, False),
])

# Columns of ``current`` the upsert does not overwrite: they keep the first version.
FEED_ITEM_KEEP_FIRST = ["id", "inserted_at", "feed_language", "feed_icon"]
FEED_ITEM_KEY = ["guid", "feed_url"]

CVE_ENRICHED = T.StructType([
    T.StructField("cve_id", S, False),
    T.StructField("source", S, False),
    T.StructField("json", S, True),
    T.StructField("cvss_base", CVSS, True),
    T.StructField("epss", EPSS, True),
    T.StructField("modified", NTZ, True),
])
CVE_KEY = ["cve_id", "source"]

EPSS_DAILY = T.StructType([
    T.StructField("as_of", D, False),
    T.StructField("cve_id", S, False),
    T.StructField("epss", EPSS, False),
    T.StructField("percentile", T.DoubleType(), True),
])

INGEST_STATE = T.StructType([
    T.StructField("source", S, False),
    T.StructField("cursor", S, True),
])

# Output of an external enrichment job; JSON arrays are kept as JSON text.
ANALYSIS = T.StructType([
    T.StructField("analysis_id", S, False),
    T.StructField("analysis_guid", S, True),
    T.StructField("archive_id", S, True),
    T.StructField("archive_guid", S, True),
    T.StructField("source_name", S, True),
    T.StructField("title", S, True),
    T.StructField("severity_level", S, True),
    T.StructField("confidence_pct", T.IntegerType(), True),
    T.StructField("summary_impact", S, True),
    T.StructField("relevance", S, True),
    T.StructField("analysed_at", NTZ, True),
    T.StructField("recommended_actions", S, True),
    T.StructField("key_iocs", S, True),
    T.StructField("cve_references", S, True),
    T.StructField("exploit_references", S, True),
])

FETCH_LOG = T.StructType([
    T.StructField("feed_name", S, False),
    T.StructField("status", S, False),
    T.StructField("duration_s", T.DoubleType(), True),
    T.StructField("ts", NTZ, False),
    T.StructField("items", T.IntegerType(), True),
])

RAW_DOC = T.StructType([
    T.StructField("url", S, False),
    T.StructField("body", S, True),
    T.StructField("content_type", S, True),
    T.StructField("status", T.IntegerType(), True),
])

# Landed upstream documents -------------------------------------------------------
# NVD page: the ``cve`` object is read as a STRING so the raw JSON text is kept.
NVD_PAGE = T.StructType([
    T.StructField("resultsPerPage", T.IntegerType()),
    T.StructField("startIndex", T.IntegerType()),
    T.StructField("totalResults", T.IntegerType()),
    T.StructField("timestamp", S),
    T.StructField("vulnerabilities", T.ArrayType(T.StructType([T.StructField("cve", S)]))),
])

KEV_FIELDS = ["cveID", "vendorProject", "product", "vulnerabilityName", "dateAdded",
              "shortDescription", "requiredAction", "dueDate", "notes"]
KEV_CATALOG = T.StructType([
    T.StructField("title", S),
    T.StructField("catalogVersion", S),
    T.StructField("dateReleased", S),
    T.StructField("count", T.IntegerType()),
    T.StructField("vulnerabilities", T.ArrayType(T.StructType([T.StructField(f, S) for f in KEV_FIELDS]))),
])

# EPSS API page: numbers arrive as strings.
EPSS_PAGE = T.StructType([
    T.StructField("status", S),
    T.StructField("total", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("limit", T.LongType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("cve", S), T.StructField("epss", S),
        T.StructField("percentile", S), T.StructField("date", S),
    ]))),
])
