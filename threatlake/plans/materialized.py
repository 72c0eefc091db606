"""Materialized relations: precomputed snapshots of the expensive documented relations,
refreshed on demand, read like tables.

A refresh writes a complete new version folder, then appends one row to the relation's
pointer table (``_versions``: version, path, refreshed_at). Readers resolve the newest
version from the pointer table, so they never see a half-written refresh, and a failed
refresh leaves the previous version in place. Old versions can be removed by retention
outside the query path.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from threatlake.plans import relations as rel

# name -> builder over a table set (``bindings.Tables`` / ``layout.StoredTables``)
MATERIALIZED = {
    "analysis_cve_mentions": lambda t: rel.cve_mentions(t.analysis),
    "analysis_cve_mentions_v2": lambda t: rel.cve_mentions_v2(t.archive, t.analysis),
    "campaign_cve_rollups": lambda t: rel.campaign_cve_rollups(t.analysis, t.cve_enriched, t.epss_daily,
                                                               getattr(t, "epss_latest", None)),
}


def refresh(spark: SparkSession, tables, root: str, names=None) -> dict:
    """Recompute and publish the named materialized relations (all by default); returns
    name -> published version path."""
    out = {}
    for name in names or sorted(MATERIALIZED):
        version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
        path = f"{root}/{name}/v={version}"
        MATERIALIZED[name](tables).write.mode("overwrite").parquet(path)
        (spark.range(1).select(F.lit(version).alias("version"), F.lit(path).alias("path"),
                               F.current_timestamp().cast("timestamp_ntz").alias("refreshed_at"))
         .write.mode("append").parquet(f"{root}/{name}/_versions"))
        out[name] = path
    return out


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest published version of a materialized relation."""
    try:
        versions = spark.read.parquet(f"{root}/{name}/_versions")
    except AnalysisException as e:
        raise LookupError(f"{name} has not been refreshed under {root}") from e
    path = versions.orderBy(F.col("refreshed_at").desc(), F.col("version").desc()).select("path").first()[0]
    return spark.read.parquet(path)
